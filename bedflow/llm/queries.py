"""The registered queries of the operators, each over its whole table, and
their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bedflow.llm import (
    chat, exact_dedup, language_id, line_dedup, neighbours, packing, pieces, sharding, simhash, spelling, toxicity, warc,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), neighbours.every())


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.read_back(chat.format_chats(chat.planted(table(spark, sf_dir, "conversations"))))


def op7_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.reshard_files(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(language_id.page_rows(table(spark, sf_dir, "pages")), ["page_id"])


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_simhash, op2_packing, op3_toxicity, op4_nearest, op5_sentencepiece, op6_chat_format, op7_resharding,
        op8_language_id, op9_exact_dedup, op10_line_dedup, op11_whitening, op12_warc, op13_spelling)}

ORACLE_SQL: dict[str, str] = {
    # the end mark costs one sign to escape, wherever a text holds it before a newline
    "op6_chat_format": r"""
        with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
                   union all values (-7, 0, 'user', '\### Assistant: </turn> ok'),
                                    (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
        r as (select *, 14 + length(role) + length(text) + case when contains(text, '</turn>' || chr(10)) then
                1 + (length(text) - length(replace(text, '</turn>', ''))) // 7
                + (length(text) - length(replace(text, '</\', ''))) // 3 else 0 end as chars from t)
        select conv_id, count(*) as n_turns,
          sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
          cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
          sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), ''))
            as loss_sha256,
          cast(sum(chars) as bigint) as formatted_chars
        from r group by conv_id""",
    "op9_exact_dedup": """
        with t as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                            'abcdefghijklmnopqrstuvwxyz') as norm from documents),
        g as (select norm, max(doc_id) as keep_id, count(*) as group_size from t group by norm)
        select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept, sha256(t.norm) as text_sha256
        from t join g using (norm)""",
    "op12_warc": """
        with t as (select page_id, coalesce(html, '') as body from pages),
        p as (select page_id, cast(strlen(body) as bigint) as payload_bytes, sha256(body) as payload_digest from t),
        g as (select payload_digest, min(page_id) as first from p group by payload_digest)
        select page_id, payload_bytes, payload_digest,
          case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
          case when payload_bytes >= 100 and page_id <> first then first end as refers_to
        from p join g using (payload_digest)""",
}

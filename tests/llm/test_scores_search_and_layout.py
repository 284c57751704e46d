"""Toxicity, language ID, nearest neighbours, chat formatting, resharding and
the pipeline."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bedflow.llm import chat, language_id, neighbours, sharding, toxicity

from tests.conftest import SF001, SF01
from tests.llm.test_dedup import docs


# --- toxicity -----------------------------------------------------------------

def test_toxicity_finds_held_out_documents(spark):
    from bedflow.llm.queries import op3_toxicity
    sf = SF01.replace("0.01", "0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    out = op3_toxicity(spark, sf).cache()
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    rows = out.join(labels, "doc_id").where("held_out").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    tox, clean = [r for r in rows if r["toxic"] == 1], [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in tox) >= 0.9 * len(tox)  # some labels of the table are noise
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)


def test_held_out_labels_teach_nothing(spark):
    table = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.score_documents(table, x).collect())) for x in (labels, turned))
    assert a == b


def test_toxicity_edge_rows(spark):
    rows = [(1, None), (2, ""), (None, "text"), (3, "w " * 30_000), (3, "again")]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.score_documents(docs(spark, rows), none).collect()
    assert len(got) == 5 and all(r["score"] == 0 and r["predicted"] == 0 for r in got)
    one = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.score_documents(docs(spark, rows), one).collect()} <= {0.0, 1.0}
    assert toxicity.score_documents(docs(spark, []), none).count() == 0
    kept = toxicity.drop_toxic(docs(spark, rows), none)
    assert kept.columns == ["doc_id", "text", "lang", "fp", "bucket"] and kept.count() == 5


def test_features_of_plain_cases():
    lex = {"idiot": 3.0, "lowei-": 2.0}
    got = dict(zip(toxicity.FEATURES, toxicity.dense_features("You 1diot! LOWEISE", lex)))
    assert got["distinct_hits"] == 2 and got["max_weight"] == 3.0 and got["near_second_person_per_100"] > 0
    assert got["disguised_per_100"] > 0 and got["shouted_words"] > 0
    assert len(toxicity.dense_features("", lex)) == len(toxicity.FEATURES)


# --- language ID --------------------------------------------------------------

def test_language_of_pages_and_documents(spark):
    from bedflow.llm.queries import op8_language_id
    got = op8_language_id(spark, SF01).collect()
    assert len(got) == spark.read.parquet(f"{SF01}/pages.parquet").count()
    assert np.mean([r["language"] == r["declared"] for r in got]) > 0.97
    table = spark.read.parquet(f"{SF01}/documents.parquet")
    kept = language_id.keep_known_languages(table)
    assert kept.columns == table.columns and kept.count() >= 0.995 * table.count()


def test_language_rejects_other_texts_and_uses_evidence(spark):
    table = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang", "source")
    odd = spark.createDataFrame(
        [(-1, "это совсем другой язык и здесь много букв " * 20, "en", "src1"), (-2, None, "de", "new"),
         (-3, "", None, None), (None, "это другой язык " * 9, None, "src1"), (-4, "12345 !!! 678", "fr", "src2"),
         (-5, "это" * 40_000, "xx", None)], table.schema)
    rows = table.unionByName(odd).withColumn("language", F.lit("clash")).withColumn("ll", F.lit(1))
    found = {r["doc_id"]: r for r in language_id.identify(language_id.document_rows(rows), ["doc_id"]).collect()}
    assert found[-1]["language"] == "und" and found[-5]["language"] == "und"
    assert found[-2]["language"] == "de" and found[-4]["language"] == "fr"
    kept = {r["doc_id"] for r in language_id.keep_known_languages(rows).collect()}
    assert -1 not in kept and -5 not in kept and {-2, -4, None} <= kept


def test_language_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert language_id.identify(language_id.document_rows(empty), ["doc_id"]).count() == 0
    pages = spark.createDataFrame([(1, None, None), (2, "not a url", "<HTML LANG='fr-CA'><p>le")],
                                  "page_id long, url string, html string")
    got = {r["page_id"]: r for r in language_id.identify(language_id.page_rows(pages), ["page_id"]).collect()}
    assert len(got) == 2 and got[2]["declared"] == "fr" and got[1]["declared"] is None


def test_trigrams_of_cut_texts_equal_those_of_whole_ones():
    text = "abc déf ghi " * 500
    whole = language_id._trigrams([text])[0]
    parts = [language_id._trigrams(p)[0] for p, _ in language_id._chunks([text], 100)]
    # each cut repeats two signs so that no trigram is lost or told twice
    assert sorted(whole) == sorted(itertools.chain.from_iterable(parts))


# --- nearest neighbours -------------------------------------------------------

def brute_nearest(ids, vecs, k):
    out = {}
    for q in ids[ids % 20 == 0]:
        s = (vecs * vecs[ids == q][0]).sum(1)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[q] = [(ids[i], s[i]) for i in order]
    return out


@pytest.mark.parametrize("sf", [SF01, SF01.replace("0.01", "0.1")])
def test_nearest_recall_on_whole_table(spark, sf):
    from bedflow.llm.queries import op4_nearest
    pdf = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    ids, vecs = pdf["vec_id"].to_numpy(), np.array(pdf["embedding"].tolist(), float)
    want = brute_nearest(ids, vecs, 20)
    got = {}
    for r in op4_nearest(spark, sf).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r)
    assert set(got) == set(want)
    hit = 0
    by_id = dict(zip(ids, vecs))
    for q, rows in got.items():
        assert [r["rank"] for r in rows] == list(range(1, 21))
        assert all(abs(r["score"] - by_id[q] @ by_id[r["vec_id"]]) < 1e-12 for r in rows)
        assert sorted((-r["score"], r["vec_id"]) for r in rows) == [(-r["score"], r["vec_id"]) for r in rows]
        hit += len({r["vec_id"] for r in rows} & {i for i, _ in want[q]})
    assert hit >= 0.9 * sum(map(len, want.values()))


def test_nearest_of_unequal_norms_in_small_blocks(spark):
    rng = np.random.default_rng(3)
    vecs = rng.standard_normal((3000, 16)) * rng.lognormal(0, 0.4, (3000, 1))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vecs)],
                               "vec_id long, embedding array<double>, score int")
    want = brute_nearest(np.arange(3000), vecs, 20)
    hit = sum(r["vec_id"] in {i for i, _ in want[r["query_id"]]}
              for r in neighbours.nearest(df, neighbours.every(), block=1500).collect())
    assert hit >= 0.9 * 20 * len(want)


def test_queries_are_asked_in_chunks_of_bounded_size(spark):
    rng = np.random.default_rng(5)
    vecs = rng.standard_normal((4000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>")
    queries = df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    own, asked = neighbours.dealt(df, queries, 4, 40)  # 100 queries a chunk
    for side, n, most in ((own, 40, 1200), (asked, 4, 150)):
        sizes = [r["count"] for r in side.groupBy("block", "chunk").count().collect()]
        assert len(sizes) == 160 and sum(sizes) == n * 4000 and max(sizes) <= most
    want, got = brute_nearest(np.arange(4000), vecs, 20), {}
    for r in neighbours.nearest(df, neighbours.every(), block=2000, chunk=20).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert set(got) == set(want) and all(len(set(x)) == len(x) == 20 for x in got.values())
    assert sum(len(set(got[q]) & {i for i, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)


def test_nearest_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (None, [1.0, 1.0]), (1, [2.0, 0.0]), (8, [1.0, 1.0, 1.0]), (20, []),
            (40, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(0))
    got = [tuple(r) for r in neighbours.nearest(df, neighbours.every()).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 40, -1.0),
                   (40, 1, 0, -1.0), (40, 2, 1, -2.0), (40, 3, 2, -2.0)]
    assert neighbours.nearest(df.limit(0), neighbours.every()).count() == 0


# --- chat formatting ----------------------------------------------------------

SIGNS = st.sampled_from(["\\", "</turn>", "###", "### ", "\n", "<", "/", "!", ":", "l", "h", "turn>", "</", "\\turn>", "é", " "])


@given(st.lists(SIGNS, max_size=10).map("".join), st.lists(SIGNS, max_size=4).map("".join))
@settings(max_examples=500, deadline=None)
def test_turn_comes_back(text, role):
    made = chat.render_turn(role, text)
    assert chat.parse_turn(made)[:2] == (role, text)
    two = made + chat.render_turn("user", text)
    again = chat.parse_turn(two, chat.parse_turn(two)[4])
    assert again[:2] == ("user", text) and again[4] == len(two)


def brute_chat(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        said = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
                     len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_chat_query_equals_brute_force(spark):
    from bedflow.llm.queries import op6_chat_format
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    text = "\\### Assistant: </turn> ok"
    want = brute_chat(rows + [(-7, 0, "user", text), (-7, 1, "assistant", text)])
    got = op6_chat_format(spark, SF001).collect()
    assert {r["conv_id"]: tuple(r)[1:5] for r in got} == want and len(got) == len(want)


def test_chat_edge_rows_and_spans(spark):
    rows = [(1, 2, "assistant", "b</turn>\n"), (1, 1, "user", None), (1, 1, "assistant", ""), (None, 0, None, "x"),
            (2, None, "assistant", "y" * 50_000), (2, None, "assistant", "y" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn(
        "position", F.lit("clash"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        made = chat.format_chats(df)
        got = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(made).collect()}
        parts = made.orderBy("conv_id", "position").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_chat(rows)
    whole = "".join(r["rendered"] for r in parts if r["conv_id"] == 1)
    assert [whole[r["loss_start"]:r["loss_end"]] for r in parts if r["conv_id"] == 1 and r["loss_start"] is not None
            ] == ["", "b</\\turn>\n"]
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0


# --- resharding ---------------------------------------------------------------

def least_bytes(sizes, shards):
    """Fewest bytes to move: try every choice of the shards that get the spare rows."""
    total = sum(map(len, sizes.values()))
    low, spare = divmod(total, shards)
    best = None
    for extra in itertools.combinations(range(shards), spare):
        moved = sum(sum(sorted(own)[:max(0, len(own) - (low + (i in extra)) if i < shards else len(own))])
                    for i, own in sizes.items())
        best = moved if best is None else min(best, moved)
    return best


def test_flow_moves_the_fewest_bytes():
    r = random.Random(7)
    for _ in range(60):
        shards = r.randint(1, 5)
        sizes = {i: [r.randint(8, 99) for _ in range(r.choice([0, 1, 3, 12]))] for i in range(r.randint(1, 7))}
        sizes = {i: sorted(s) for i, s in sizes.items() if s}
        moves = sharding.solve({i: [(1, x) for x in s] for i, s in sizes.items()}, shards)
        seen, slots, moved = {}, {}, 0
        for m in moves:
            seen.setdefault(m.old, []).extend(range(m.first, m.first + m.n))
            slots.setdefault(m.shard, []).extend(range(m.slot, m.slot + m.n))
            moved += sum(sizes[m.old][m.first:m.first + m.n]) * (m.old != m.shard)
        assert {i: sorted(x) for i, x in seen.items()} == {i: list(range(len(s))) for i, s in sizes.items()}
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
        counts = [len(slots.get(j, [])) for j in range(shards)]
        assert max(counts) - min(counts) <= 1
        assert moved == least_bytes(sizes, shards)


def test_reshard_whole_table(spark):
    from bedflow.llm.queries import op7_resharding
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = op7_resharding(spark, SF001).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(table)
    by = {}
    for r in rows:
        raw = (table[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 8, zlib.crc32(raw), "rows", None)
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    counts = [len(by.get(j, [])) for j in range(24)]
    assert max(counts) - min(counts) <= 1


def test_reshard_edge_rows_and_rewrite(spark, tmp_path):
    rows = [(None, None), (None, None), (1, ""), (2, "é" * 70_000), (3, "same"), (4, "same")]
    got = sharding.reshard(docs(spark, rows), F.lit(0), shards=4).collect()
    assert len(got) == 6 and sorted(r["size"] for r in got) == [8, 8, 8, 12, 12, 140_008]
    assert [r["shard"] for r in got if r["size"] == 140_008] == [0]  # the largest stays
    assert sharding.reshard(docs(spark, []), F.lit(0)).count() == 0
    many = docs(spark, [(i, "t" * i) for i in range(40)])
    placed = sharding.reshard(many, F.when(F.col("doc_id") < 10, 1).otherwise(0), shards=4)
    placed = spark.createDataFrame(placed.collect(), placed.schema)
    sharding.rewrite(many, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    changed = {r["shard"] for r in placed.collect() if r["shard"] != r["old_shard"]} | {0}
    want = {(r["doc_id"], r["shard"]) for r in placed.collect() if r["shard"] in changed}
    assert 1 not in changed and {(r["doc_id"], r["shard"]) for r in back.select("doc_id", "shard").collect()} == want


def test_reshard_writes_every_row_once(spark, tmp_path):
    rows = [(None, "a"), (None, "a"), (None, None), (7, "bb"), (7, "bb"), (7, "ccc"), (8, ""), (9, "é")]
    path = str(tmp_path / "files")
    old = sharding.lay_out(docs(spark, rows), F.when(F.col("doc_id") == 7, 5).otherwise(0), path)
    sharding.rewrite(old, sharding.reshard(old, F.col("shard"), shards=3), path)
    back = sharding.slots(spark.read.parquet(path)).collect()  # old shard 5 has no rows any more, and no files
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in back))) == sorted(map(str, rows))
    assert sorted((r["shard"], r["slot"]) for r in back) == [(s, i) for s, n in enumerate((3, 3, 2)) for i in range(n)]
    with pytest.raises(ValueError):
        plain = docs(spark, rows)
        sharding.rewrite(plain, sharding.reshard(plain, F.lit(0), shards=3), str(tmp_path / "other"))


def test_reshard_files_reads_back_what_it_wrote(spark):
    rows = [(None, None), (None, None), (3, "x"), (3, "x"), (4, "é" * 9), (5, "y"), (6, "z"), (6, "zz")]
    # shard 0 has two rows and keeps its files; 1 and 2 have none; 9 goes
    old = F.when(F.col("doc_id").isin(4, 5), 0).otherwise(9)
    got = sharding.reshard_files(docs(spark, rows), old, shards=4).collect()
    assert sorted((r["shard"], r["slot"]) for r in got) == [(s, i) for s in range(4) for i in range(2)]
    want = sorted(str((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))) for i, t in rows)
    assert sorted(str((r["doc_id"], r["size"], r["text_crc32"])) for r in got) == want
    assert {r["doc_id"] for r in got if r["shard"] == 0} == {4, 5} and {r["old_shard"] for r in got} == {0, 9}
    assert sharding.reshard_files(docs(spark, []), F.lit(0)).columns == got[0].__fields__


# --- pipeline -----------------------------------------------------------------

def test_pipeline_stages_and_run(spark):
    import corpus_pipeline
    from tests.llm.test_dedup import brute_components, brute_exact, brute_fingerprint
    from tests.llm.test_packing_and_pieces import check_packed

    columns = spark.read.parquet(f"{SF001}/documents.parquet").columns
    table = spark.read.parquet(f"{SF001}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "toxicity", "exact_dedup", "simhash", "packing"]
    at = {}
    for name, function in corpus_pipeline.STAGES:
        table = corpus_pipeline.stage(function(spark, table, SF001), name)
        at[name] = table
        assert name == "packing" or table.columns == columns
    before = [(r["doc_id"], r["text"]) for r in at["toxicity"].collect()]
    assert {r["doc_id"] for r in at["exact_dedup"].collect()} == {k for _, k, *_ in brute_exact(before)}
    before = at["exact_dedup"].collect()
    ids = [r["doc_id"] for r in before]
    comps = brute_components(ids, [brute_fingerprint(r["text"]) for r in before])
    assert {r["doc_id"] for r in at["simhash"].collect()} == set(comps)
    assert {r["doc_id"] for r in at["packing"].collect()} == set(comps)
    check_packed(at["packing"].collect(), 2048)
    run = corpus_pipeline.run(spark, SF001)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, at["packing"].collect()))


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline
    table = spark.read.parquet(f"{SF001}/documents.parquet")
    table.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF001}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


# --- SQL ----------------------------------------------------------------------

@pytest.mark.parametrize("sf", [SF001, SF01])
def test_queries_equal_their_sql(spark, sf):
    import duckdb

    from bedflow.llm.queries import ORACLE_SQL, QUERIES
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    for name, sql in ORACLE_SQL.items():
        got = QUERIES[name](spark, sf)
        want = con.execute(sql)
        columns = sorted(d[0] for d in want.description)
        order = [[d[0] for d in want.description].index(c) for c in columns]
        assert sorted(got.columns) == columns
        assert sorted(map(tuple, got.select(*columns).collect())) == sorted(
            tuple(r[i] for i in order) for r in want.fetchall()), name

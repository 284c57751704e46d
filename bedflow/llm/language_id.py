"""Language ID by Bayesian evidence fusion.

The log posterior of a language adds
 * the text's likelihood under character-trigram models, one a language, plus
   a flat model for text in none of them ("und"),
 * the likelihood of the declared markup language, and of the address suffix,
   under smoothed tables of what pages of each language declare,
 * the log prior of the host, smoothed hierarchically: all rows -> suffix ->
   domain -> host.
The tables and priors are grouped aggregations over all rows of the input;
only the trigram models are fitted on a bounded sample (``TRAIN_ROWS``).
Trigrams overlap, so the text's log likelihood is tempered to a limited number
of independent ones (``TEMPER``); the whole text is always read.
"""

from __future__ import annotations

import html as html_lib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedflow.llm.common import map_arrow, stage, text_hash, without_texts

LANGUAGES = ("en", "de", "fr", "es")
#: Rows the trigram models are fitted on, about; chosen by a hash of the text.
TRAIN_ROWS = 8_000
#: Trigram classes (hashed).
CLASSES = 1 << 16
#: A text counts as this many independent trigrams at most.
TEMPER = 40.0
#: Strength of each parent in the smoothing of host priors and evidence tables.
STRENGTH = 20.0
UND = "und"

_TAGS = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", re.S | re.I)


def visible_text(page: str) -> str:
    """Text of an HTML page without tags, scripts, styles and comments."""
    return html_lib.unescape(_TAGS.sub(" ", page))


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram classes of lower-cased texts and each one's text number; digits,
    punctuation and white space all count as one space, and classes of three
    spaces are left out."""
    joined = "   ".join(texts).lower() + "   "
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    sizes = [n for t in texts for n in (len(t.lower()), 3)]
    owner = np.repeat([n for i in range(len(texts)) for n in (i, -1)], sizes)  # -1: between two texts
    low = code < 0xC0
    letter = ~low | ((code >= 97) & (code <= 122))
    code = np.where(letter, code, 32).astype(np.uint32)
    mixed = (code[:-2] * np.uint32(0x9E3779B1) ^ code[1:-1] * np.uint32(0x85EBCA77) ^ code[2:] * np.uint32(0xC2B2AE3D))
    use = letter[:-2] | letter[1:-1] | letter[2:]
    use &= (owner[:-2] == owner[2:]) & (owner[:-2] >= 0)
    return ((mixed ^ (mixed >> np.uint32(15))) & np.uint32(CLASSES - 1))[use], owner[:-2][use]


def _chunks(texts: list[str], size: int = 1 << 18):
    """Slices of about ``size`` characters; one long text is cut into overlapping parts."""
    part, owners, n = [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - 2), size):
            part.append(t[a:a + size + 2])
            owners.append(i)
            n += len(part[-1])
            if n >= size:
                yield part, owners
                part, owners, n = [], [], 0
    if part:
        yield part, owners


def fit(rows: DataFrame, languages=LANGUAGES, train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Log probabilities (class, language + und) from about ``train_rows`` of
    ``rows`` (text, declared, is_html) that declare one of the languages."""
    langs = list(languages)
    known = rows.where(F.col("declared").isin(langs) & (F.length("text") > 0))
    total = known.count()
    share = max(1, total // train_rows)
    sample = known.where(F.pmod(F.xxhash64("text"), F.lit(share)) == 0).select("declared", "text", "is_html")

    def count(batches):
        sums = np.zeros((len(langs), CLASSES), np.int64)
        for b in batches:
            names = b.column(0).to_pylist()
            texts = _texts(b.column(1), b.column(2))
            for part, owners in _chunks(texts):
                got, owner = _trigrams(part)
                lang = np.array([langs.index(names[o]) for o in owners])[owner]
                sums += np.bincount(lang * CLASSES + got, minlength=sums.size).reshape(sums.shape)
        lang, cls = np.nonzero(sums)
        yield pa.record_batch([pa.array(lang), pa.array(cls), pa.array(sums[lang, cls])], names=["l", "c", "n"])

    # at most languages x classes rows
    sums = (sample.mapInArrow(count, "l long, c long, n long").groupBy("l", "c").agg(F.sum("n").alias("n"))
            .toPandas())
    n = np.zeros((CLASSES, len(langs)))
    n[sums["c"].to_numpy(int), sums["l"].to_numpy(int)] = sums["n"].to_numpy(float)
    p = (n + 0.05) / (n.sum(0) + 0.05 * CLASSES)
    return np.log(np.column_stack((p, np.full(CLASSES, 1 / CLASSES)))).astype(np.float32)


def _texts(text: pa.Array, is_html: pa.Array) -> list[str]:
    return [visible_text(t or "") if h else t or "" for t, h in zip(text.to_pylist(), is_html.to_pylist())]


def _address(url: Column) -> dict[str, Column]:
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    labels = F.split(host, r"\.")
    return {"host": host, "domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
            "suffix": F.element_at(labels, -1)}


def evidence(rows: DataFrame, model: np.ndarray, languages=LANGUAGES, keys: list[str] = ()) -> DataFrame:
    """``keys``, declared, host, domain, suffix, and ``ll``: tempered log
    likelihoods of the text per language and und (all zero without letters)."""
    cols = [*keys, "declared", "host", "domain", "suffix"]

    def score(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = _texts(b.column("text"), b.column("is_html"))
        ll, n = np.zeros((len(texts), model.shape[1])), np.zeros(len(texts))
        for part, owners in _chunks(texts):
            got, owner = _trigrams(part)
            if len(got):
                at = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
                who = np.array(owners)[owner[at]]
                np.add.at(ll, who, np.add.reduceat(model[got], at, axis=0, dtype=np.float64))
                np.add.at(n, who, np.diff(np.concatenate((at, [len(got)]))))
        ll *= np.minimum(1.0, TEMPER / np.maximum(n, 1))[:, None]
        return pa.record_batch([*[b.column(c) for c in cols], pa.array(list(ll), pa.list_(pa.float64()))],
                               names=[*cols, "ll"])

    src = rows.select(*cols, "text", "is_html")
    schema = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in cols) + ", ll array<double>"
    return map_arrow(src, score, schema)


def fuse(found: DataFrame, languages=LANGUAGES) -> DataFrame:
    """Adds language, confidence and the posterior array to staged ``found``."""
    langs = [*languages, UND]
    best = F.col("ll")
    likely = F.expr(f"element_at(array({', '.join(repr(x) for x in langs)}), "
                    "cast(array_position(ll, array_max(ll)) as int))")
    named = found.withColumn("text_lang", F.when(F.array_max(best) != 0, likely)
                             .when(F.col("declared").isin(langs), F.col("declared")).otherwise(F.lit(UND)))
    hierarchy = ["suffix", "domain", "host"]
    # one pass: counts by host and what it declares; every table below sums these up
    counts = stage(named.groupBy("declared", *hierarchy).agg(
        *[F.sum((F.col("text_lang") == x).cast("long")).alias(x) for x in langs]), "langid-counts")

    def level(by: list[str]) -> DataFrame:
        t = counts.groupBy(*by).agg(*[F.sum(x).alias(x) for x in langs]) if by else counts.agg(
            *[F.sum(x).alias(x) for x in langs])
        return t.select(*by, F.array(*[F.coalesce(F.col(x), F.lit(0)).cast("double") for x in langs]).alias("n"))

    n_langs = len(langs)
    top = level([]).first()  # one row
    total = sum(top["n"]) if top else 0.0
    base = [(x + 1.0) / (total + n_langs) for x in (top["n"] if top else [0.0] * n_langs)]
    prior = F.array(*[F.lit(float(p)) for p in base])
    priors = level(hierarchy)
    for depth in range(1, 4):
        by = hierarchy[:depth]
        up = level(by).withColumnRenamed("n", f"n{depth}")
        if depth < 3:
            priors = priors.join(up.select(*[F.col(c).alias(f"_{c}") for c in by], f"n{depth}"),
                                 [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]).drop(*[f"_{c}" for c in by])
        else:
            priors = priors.withColumn("n3", F.col("n"))
        priors = priors.withColumn("prior", _smoothed(F.col(f"n{depth}"), F.col("prior") if depth > 1 else prior))

    def table(name: str) -> DataFrame:
        """log P(value | language) of the evidence ``name``, smoothed towards its overall share."""
        t = counts.where(F.col(name).isNotNull() & (F.col(name) != "")).groupBy(name).agg(
            *[F.sum(x).alias(x) for x in langs])
        sums = t.agg(*[F.sum(x).alias(x) for x in langs]).first()
        per = [float(sums[x] or 0) for x in langs]
        every = sum(per) or 1.0
        share = sum((F.col(x) for x in langs), F.lit(0.0)) / every
        return t.select(F.col(name).alias(f"_{name}"), F.array(*[
            F.log((F.col(x) + STRENGTH * share) / (F.lit(p) + STRENGTH)) for x, p in zip(langs, per)])
            .alias(f"log_{name}"))

    out = named.join(priors.select(*[F.col(c).alias(f"_p_{c}") for c in hierarchy], "prior"),
                     [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in hierarchy], "left")
    for name in ("declared", "suffix"):
        out = out.join(table(name), F.col(name) == F.col(f"_{name}"), "left")
    zero = F.array(*[F.lit(0.0)] * n_langs)
    logs = F.zip_with(F.zip_with("ll", F.transform(F.coalesce("prior", prior), lambda x: F.log(x)), lambda a, b: a + b),
                      F.zip_with(F.coalesce("log_declared", zero), F.coalesce("log_suffix", zero),
                                 lambda a, b: a + b), lambda a, b: a + b)
    odds = F.transform("logs", lambda x: F.exp(x - F.array_max("logs")))
    out = out.withColumn("logs", logs).withColumn("odds", odds).withColumn(
        "posterior", F.transform("odds", lambda x: x / F.aggregate("odds", F.lit(0.0), lambda a, b: a + b)))
    names = F.array(*[F.lit(x) for x in langs])
    return out.select(
        *found.columns, "text_lang", "posterior",
        F.element_at(names, F.array_position("posterior", F.array_max("posterior")).cast("int")).alias("language"),
        F.array_max("posterior").alias("confidence"))


def _smoothed(n: Column, parent: Column) -> Column:
    size = F.aggregate(n, F.lit(0.0), lambda a, b: a + b)
    return F.zip_with(n, parent, lambda a, p: (a + STRENGTH * p) / (size + STRENGTH))


def identify(rows: DataFrame, keys: list[str], languages=LANGUAGES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``keys``, declared, host, text_lang (by the text alone), language and
    confidence for every row of ``rows`` (keys, text, is_html, declared, host,
    domain, suffix).

    Null text counts as empty; a text without letters has no text evidence and
    is judged by the rest.  A missing declaration or address adds nothing.
    Ties go to the language named first.  Repeated rows repeat; an empty table
    gives no rows.  Rows are read in two passes (sample and scores).
    """
    model = fit(rows, languages, train_rows)
    found = stage(evidence(rows, model, languages, keys), "langid-evidence")
    return fuse(found, languages).drop("ll", "posterior")


def page_rows(pages: DataFrame) -> DataFrame:
    """Input rows of ``identify`` from (page_id, url, html); the declared
    language is that of the html tag, without its region."""
    lang = F.lower(F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1))
    parts = _address(F.coalesce("url", F.lit("")))
    return pages.select("page_id", F.col("html").alias("text"), F.lit(True).alias("is_html"),
                        F.when(lang != "", lang).alias("declared"), *[c.alias(k) for k, c in parts.items()])


def document_rows(docs: DataFrame) -> DataFrame:
    """Input rows of ``identify`` from documents: ``lang`` is the declaration,
    ``source`` the host; there is no address suffix."""
    empty = F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(False).alias("is_html"),
                       F.col("lang").alias("declared"), F.col("source").alias("host"),
                       empty.alias("domain"), empty.alias("suffix"))


def keep_known_languages(docs: DataFrame, languages=LANGUAGES, min_confidence: float = 0.5,
                         train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Rows of ``docs``, all columns, whose language is one of ``languages``
    with ``min_confidence``.  Texts of no known language, and empty texts of
    rows that declare none, go; rows that share a doc_id go each by its own
    text (equal ones all stay if one is accepted).  Rows without a doc_id stay."""
    rows = document_rows(docs).withColumn("t", text_hash())
    found = identify(rows, ["doc_id", "t"], languages, train_rows)
    gone = stage(found.groupBy("doc_id", "t").agg(
        F.bool_or((F.col("language") != UND) & (F.col("confidence") >= min_confidence)).alias("accepted"))
        .where("not accepted and doc_id is not null").select("doc_id", "t"), "langid-gone")
    return without_texts(docs, gone)

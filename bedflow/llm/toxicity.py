"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic
regression.

The lexicon is learned from the training rows: words, and word beginnings for
languages that build insults by compounding, that are far commoner in toxic
texts.  Before the lookup a word loses its disguise: signs that look like
letters are replaced ("1d10t"), letters set apart are joined ("s.t.u.p.i.d"),
and a word with stars is read as the heaviest entry of the same length and
letters ("st*pid", "f***").  Each
whole text becomes a row of densities: lexicon hits, hits near second-person
words, capitals, punctuation, and disguised words.  Spark ML fits the trees on
a bounded sample of the labelled training rows and the isotonic step function
on another part of it; scoring runs over all rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedflow.llm.common import map_arrow, stage, text_hash, without_texts

#: Labelled rows the model is fitted on at most, about; chosen by a hash of doc_id.
MAX_TRAIN = 24_000
#: Lexicon entries at most.
MAX_LEXICON = 400
#: How many times commoner in toxic texts an entry must be.
LEAST_ODDS = 5
THRESHOLD = 0.3
NEAR = 5
PREFIXES = (4, 5, 6)
FEATURES = ["log_words", "hits_per_100", "weight_per_100", "log_hits", "max_weight", "distinct_hits",
            "near_second_person_per_100", "second_person_per_100", "capitals", "shouted_words", "punctuation",
            "exclamations", "disguised_per_100", "stretched_per_100", "digits"]

_WORD = re.compile(r"\w[\w@$*!|]*[\w*]|\w")
#: Letters set apart, four or more, always by the same sign: "i d i o t", "s.t.u.p.i.d".
_SPACED = re.compile(r"(?<!\w)[^\W\d_]([ .\-_*])[^\W\d_](?:\1[^\W\d_]){2,}(?!\w)")
_STRETCHED = re.compile(r"(\w)\1{3,}")
_LOOKALIKE = str.maketrans("013457@$!|", "oieastasil")
# Second-person words of the four languages (fixed values).
_YOU = frozenset("you your yours yourself du dich dir dein deine ihr euch euer sie tu te toi ton ta tes vous votre "
                 "vos tú ti tuyo usted ustedes vosotros".split())


def held_out() -> Column:
    """The fold that no label is learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


class Masks:
    """Words of a lexicon by length, to find what a word with stars hides."""

    def __init__(self, lexicon: dict[str, float]) -> None:
        self.by_length: dict[int, list[str]] = {}
        for entry in sorted(lexicon, key=lambda e: (-lexicon[e], e)):
            if not entry.endswith("-"):
                self.by_length.setdefault(len(entry), []).append(entry)

    def uncovered(self, word: str) -> str:
        """The heaviest entry of the same length and letters; else the word itself."""
        for entry in self.by_length.get(len(word), ()):
            if all(c in ("*", e) for c, e in zip(word, entry)):
                return entry
        return word


def _words(text: str, masks: Masks | None = None) -> tuple[list[str], int]:
    """Lower-cased words, and how many were disguised: signs that look like
    letters are replaced inside words, letters set apart are joined, and stars
    inside or at the end of a word (two or more there; one is emphasis) are looked up in ``masks``."""
    text, disguised = text.lower(), 0
    joined = _SPACED.sub(lambda m: m.group(0).replace(m.group(1), ""), text)
    if joined is not text:
        disguised, text = sum(1 for _ in _SPACED.finditer(text)), joined
    out = []
    for w in _WORD.findall(text):
        if not w.isalpha() and not w.isdigit():
            if w.endswith("*") and not w.endswith("**") and "*" not in w[:-1]:
                w = w[:-1]
            plain = w.translate(_LOOKALIKE)
            if any(c.isalpha() for c in w) and (plain != w or "*" in w):
                disguised += 1
            w = masks.uncovered(plain) if masks is not None and "*" in plain else plain
        out.append(w)
    return out, disguised


def _entries(word: str) -> list[str]:
    """The lexicon entries a word can match: itself and its beginnings."""
    return [word, *[word[:k] + "-" for k in PREFIXES if len(word) > k]]


def learn_lexicon(train: DataFrame, max_entries: int = MAX_LEXICON) -> dict[str, float]:
    """entry -> log odds, from (text, toxic) rows.  Equal texts count once."""
    once = train.groupBy(F.sha2(F.coalesce("text", F.lit("")), 256).alias("t")).agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic"))

    def count(batches):
        tox, all_ = Counter(), Counter()
        for b in batches:
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = {e for w in set(_words(text or "")[0]) for e in _entries(w)}
                all_.update(found)
                if label:
                    tox.update(found)
            if len(all_) > 100_000:
                yield flush(tox, all_)
                tox, all_ = Counter(), Counter()
        yield flush(tox, all_)

    def flush(tox, all_):
        keys = list(all_)
        return pa.record_batch([pa.array(keys, pa.string()), pa.array([tox[k] for k in keys], pa.int64()),
                                pa.array([all_[k] for k in keys], pa.int64())], names=["entry", "tox", "every"])

    once = stage(once.select("text", "toxic"), "toxicity-lexicon-rows")
    n_tox, n = (int(x or 0) for x in once.agg(F.sum("toxic"), F.count(F.lit(1))).first())
    if not n_tox or n_tox == n:
        return {}
    counts = once.mapInArrow(count, "entry string, tox long, every long").groupBy("entry").agg(
        F.sum("tox").alias("tox"), F.sum("every").alias("every"))
    odds = (F.log((F.col("tox") + 0.5) / (n_tox + 1.0))
            - F.log((F.col("every") - F.col("tox") + 0.5) / (n - n_tox + 1.0)))
    # an entry must be seen in enough toxic texts not to be there by chance
    least = max(5, math.ceil(0.01 * n_tox))
    top = (counts.where(F.col("tox") >= least).withColumn("odds", odds).where(F.col("odds") > math.log(LEAST_ODDS))
           .orderBy(F.desc(F.col("odds") * F.sqrt("tox")), "entry").limit(max_entries))
    return {r["entry"]: float(r["odds"]) for r in top.collect()}


def dense_features(text: str, lexicon: dict[str, float], masks: Masks | None = None) -> list[float]:
    """One row of FEATURES for a whole text; an empty text gives zeros."""
    words, disguised = _words(text, Masks(lexicon) if masks is None else masks)
    n = len(words)
    per = 100.0 / max(n, 1)
    hits, you = [], []
    weight = top = 0.0
    seen = set()
    get = lexicon.get
    for i, w in enumerate(words):
        best = get(w, 0.0)
        for k in PREFIXES:
            if len(w) > k:
                best = max(best, get(w[:k] + "-", 0.0))
        if best:
            hits.append(i)
            seen.add(w)
            weight += best
            top = max(top, best)
        if w in _YOU:
            you.append(i)
    near = 0
    if hits and you:
        at = np.searchsorted(you, hits)
        y = np.array([-10**9, *you, 10**9])
        h = np.array(hits)
        near = int((np.minimum(h - y[at], y[at + 1] - h) <= NEAR).sum())
    chars = max(len(text), 1)
    upper = sum(map(str.isupper, text))
    letters = sum(map(str.isalpha, text))
    marks = len(text) - letters - text.count(" ") - text.count("\n")
    shouted = sum(1 for w in text.split() if len(w) > 2 and w.isupper())
    digits = sum(map(str.isdigit, text))
    return [math.log1p(n), len(hits) * per, weight * per, math.log1p(len(hits)), top, float(len(seen)), near * per,
            len(you) * per, upper / max(letters, 1), shouted * per, marks / chars, text.count("!") / chars,
            disguised * per, len(_STRETCHED.findall(text)) * per, digits / chars]


def featurise(docs: DataFrame, lexicon: dict[str, float], keys: list[str]) -> DataFrame:
    """``keys`` plus one double column per feature, for every row."""
    masks = Masks(lexicon)

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [dense_features(t or "", lexicon, masks) for t in b.column("text").to_pylist()]
        table = np.array(rows, float).reshape(len(rows), len(FEATURES))
        return pa.record_batch([*[b.column(k) for k in keys], *[pa.array(c) for c in table.T]],
                               names=[*keys, *FEATURES])
    src = docs.select(*keys, F.col("text").cast("string").alias("text"))
    schema = ", ".join([*[f"`{k}` {src.schema[k].dataType.simpleString()}" for k in keys],
                        *[f"{c} double" for c in FEATURES]])
    return map_arrow(src, batch, schema)


class Model:
    """Lexicon, trees and calibration; ``trees`` is None where the training
    rows hold one class only, and every score is then ``base``."""

    def __init__(self, lexicon, trees=None, calibration=None, base=0.0):
        self.lexicon, self.trees, self.calibration, self.base = lexicon, trees, calibration, base

    def score(self, docs: DataFrame, keys: list[str]) -> DataFrame:
        rows = featurise(docs, self.lexicon, keys)
        if self.trees is None:
            return rows.select(*keys, F.lit(float(self.base)).alias("score"))
        rows = self.trees.transform(_assembled(rows))
        rows = rows.withColumn("margin", vector_to_array("probability")[1])
        return self.calibration.transform(rows).select(
            *keys, F.least(F.greatest(F.col("prediction_iso"), F.lit(0.0)), F.lit(1.0)).alias("score"))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, seed: int = 7) -> Model:
    """Fit on rows outside the held-out fold.  Repeated labels of a doc_id
    count once, toxic if any says so; null ids and labels are left out."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    share = max(1, math.ceil(known.count() / max_train))
    known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
    # at most about max_train ids are broadcast, a documented bound
    rows = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                 .join(F.broadcast(known), "doc_id"), "toxicity-train")
    lexicon = learn_lexicon(rows)
    feats = stage(featurise(rows, lexicon, ["doc_id", "toxic"]), "toxicity-features")
    n, tox = (float(x or 0) for x in feats.agg(F.count(F.lit(1)), F.sum("toxic")).first())
    if not 0 < tox < n:
        return Model(lexicon, base=tox / n if n else 0.0)
    part = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(4))
    feats = _assembled(feats.coalesce(8)).withColumn("label", F.col("toxic").cast("double"))
    fitting, rest = feats.where(part != 0), feats.where(part == 0)
    if any(x.select("label").distinct().count() < 2 for x in (fitting, rest)):
        fitting = rest = feats
    trees = GBTClassifier(maxIter=20, maxDepth=3, maxBins=32, stepSize=0.2, seed=seed, maxMemoryInMB=64,
                          labelCol="label", featuresCol="features").fit(fitting)
    margins = trees.transform(rest).select(vector_to_array("probability")[1].alias("margin"), "label")
    calibration = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="prediction_iso").fit(margins)
    return Model(lexicon, trees, calibration)


def score_documents(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``.

    A null text counts as empty and is scored like any other; a null doc_id has
    held_out false.  Without labels of both classes every score is the share of
    toxic labels (zero without any).  Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = train(docs, labels, max_train).score(docs, ["doc_id"])
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Rows of ``docs``, all columns, whose text is not predicted toxic, with a
    doc_id or without; rows that share a doc_id go each by its own text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash().alias("t"))
    scored = train(docs, labels, max_train).score(rows, ["doc_id", "t"])
    gone = stage(scored.where(F.col("score") >= THRESHOLD).select("doc_id", "t").distinct(), "toxicity-gone")
    return without_texts(docs, gone)

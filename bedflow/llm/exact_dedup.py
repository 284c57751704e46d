"""Exact dedup against an immutable snapshot, screened by static binary-fuse
filters.

Texts are equal when their UTF-8 bytes are after lower-casing A-Z.  The
snapshot's distinct digests are cut into buckets, and each bucket gets one
three-wise binary-fuse filter (about nine bits a digest).  The incoming batch
is first grouped by itself; its distinct digests meet their bucket's filter,
and only the positives join the snapshot's digests.  Groups of more than one
row then have their bytes compared: the smallest and the largest text of a
digest must be the same bytes.  These are aggregates that combine map-side, so
a group holding a third of all rows sends one row a task.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedflow.llm.common import BROADCAST_IDS, free_names, map_arrow, stage, without_ids

#: Digests a filter holds on average; sets the number of buckets.
BUCKET_DIGESTS = 40_000
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


# --- binary-fuse filter -----------------------------------------------------

def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _cells(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
    """The three cells of each hash, in three neighbouring segments."""
    first = ((h >> np.uint64(32)) * np.uint64(segment * segments)) >> np.uint64(32)
    mask = np.uint64(segment - 1)
    second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * segment)) ^ (h & mask)
    return np.stack((first, second, third)).astype(np.int64)


def _mark(h: np.ndarray) -> np.ndarray:
    return ((h ^ (h >> np.uint64(32))) & np.uint64(255)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment, segments, cells) of a filter over uint64 ``keys``."""
    keys = np.unique(keys)
    n = len(keys)
    if not n:
        return 0, 0, 0, b""
    segment = max(4, 1 << int(math.floor(math.log(max(n, 2)) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    segments = max(1, math.ceil(n * factor / segment) - 2)
    seed = 0
    while True:
        seed += 1
        h = _mix(keys, seed * 0x9E3779B9)
        cells = _cells(h, segment, segments)
        size = (segments + 2) * segment
        count = np.bincount(cells.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)  # xor of the key numbers in a cell: the key itself where one is left
        for row in cells:
            np.bitwise_xor.at(owner, row, np.arange(n))
        three, left, own = cells.T.tolist(), count.tolist(), owner.tolist()
        queue = np.flatnonzero(count == 1).tolist()
        order = []
        while queue:
            c = queue.pop()
            if left[c] != 1:
                continue
            k = own[c]
            order.append((k, c))
            for d in three[k]:
                left[d] -= 1
                own[d] ^= k
                if left[d] == 1:
                    queue.append(d)
        if len(order) == n:
            break
    table, mark = [0] * size, _mark(h).tolist()
    for k, c in reversed(order):  # a key's own cell is set last, the other two are final by then
        a, b, d = three[k]
        table[c] = mark[k] ^ table[a] ^ table[b] ^ table[d]
    return seed * 0x9E3779B9, segment, segments, bytes(table)


def may_hold(built: tuple[int, int, int, bytes], keys: np.ndarray) -> np.ndarray:
    """False only for keys that the filter surely lacks."""
    seed, segment, segments, table = built
    if not segment:
        return np.zeros(len(keys), bool)
    h = _mix(keys, seed)
    t = np.frombuffer(table, np.uint8)
    a, b, c = _cells(h, segment, segments)
    return (t[a] ^ t[b] ^ t[c]) == _mark(h)


def _keys(digests: pd.Series) -> np.ndarray:
    return np.array([int.from_bytes(d[:8], "little") for d in digests], np.uint64)


# --- the operator -----------------------------------------------------------

def normalised(docs: DataFrame, columns: list[str], keep_text: bool = False) -> DataFrame:
    """``columns`` of ``docs`` with the SHA-256 ``digest`` of the normalised
    text (null: empty), and the normalised bytes themselves if asked for."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [(t or b"").translate(_TABLE) for t in b.column("_text").to_pylist()]
        out = [b.column(c) for c in columns] + [pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())]
        return pa.record_batch(out + [pa.array(texts, pa.binary())] * keep_text,
                               names=[*columns, "digest", *["norm"] * keep_text])
    src = docs.select(*columns, F.col("text").cast("binary").alias("_text"))
    kinds = [f"`{c}` {src.schema[c].dataType.simpleString()}" for c in columns]
    return map_arrow(src, batch, ", ".join([*kinds, "digest binary", *["norm binary"] * keep_text]))


def _groups(rows: DataFrame) -> DataFrame:
    """One row a digest: rows, the largest doc_id, and how many rows have it."""
    per_id = rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    top = F.max(F.struct("doc_id", "n"))
    return per_id.groupBy("digest").agg(F.sum("n").alias("size"), top.alias("top")).select(
        "digest", "size", F.col("top.doc_id").alias("keep_id"), F.col("top.n").alias("n_keep"))


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))


def snapshot_filters(snapshot: DataFrame, incoming: int = 0) -> tuple[DataFrame, int]:
    """One filter a bucket of ``snapshot`` (distinct digests), staged, and the
    number of buckets.  A snapshot never changes, so its filters screen any
    number of batches of about ``incoming`` digests or less; a small snapshot
    does not put a large batch into few buckets."""
    buckets = max(1, math.ceil(max(snapshot.count(), incoming) / BUCKET_DIGESTS))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, segment, segments, cells = build_filter(_keys(pdf["digest"]))
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "seed": [seed], "segment": [segment],
                             "segments": [segments], "cells": [cells]})

    return stage(_bucketed(snapshot.select("digest"), buckets).groupBy("bucket").applyInPandas(
        build, "bucket int, seed long, segment long, segments long, cells binary"), "fuse-filters"), buckets


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """``incoming`` (distinct digests) plus ``maybe``: whether the filter of
    the digest's bucket admits it."""
    def test(new: pd.DataFrame, fuse: pd.DataFrame) -> pd.DataFrame:
        new["maybe"] = may_hold(tuple(fuse[["seed", "segment", "segments", "cells"]].iloc[0]),
                                _keys(new["digest"])) if len(fuse) else False
        return new.drop(columns="bucket")

    schema = ", ".join(f"{c} {t}" for c, t in incoming.dtypes) + ", maybe boolean"
    return _bucketed(incoming, buckets).groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(test, schema)


def dedup_groups(docs: DataFrame, in_snapshot, rows: DataFrame) -> DataFrame:
    """One row a group of equal texts: digest, size, keep_id, n_keep (rows that
    carry keep_id).  ``rows`` are the staged (doc_id, digest) of ``docs``;
    ``in_snapshot`` is a condition on doc_id."""
    snap = stage(_groups(rows.where(in_snapshot)), "dedup-snapshot")
    new = rows.where(~in_snapshot)
    screened = stage(screen(_groups(new), *snapshot_filters(snap, new.count())), "dedup-screened")
    known = screened.where("maybe").select("digest", F.col("size").alias("s2"), F.col("keep_id").alias("k2"),
                                           F.col("n_keep").alias("n2"))
    largest = F.greatest("keep_id", "k2")
    merged = snap.join(known, "digest", "full").select(
        "digest", (F.coalesce("size", F.lit(0)) + F.coalesce("s2", F.lit(0))).alias("size"),
        largest.alias("keep_id"),
        (F.when(F.col("keep_id").eqNullSafe(largest), F.coalesce("n_keep", F.lit(0))).otherwise(0)
         + F.when(F.col("k2").eqNullSafe(largest), F.coalesce("n2", F.lit(0))).otherwise(0)).alias("n_keep"))
    fresh = screened.where(~F.col("maybe")).select("digest", "size", "keep_id", "n_keep")
    groups = stage(merged.unionByName(fresh), "dedup-groups")
    check_bytes(docs, groups)
    return groups


def check_bytes(docs: DataFrame, groups: DataFrame) -> None:
    """Compare the bytes of every group of more than one row; raises if equal
    digests ever cover different texts (a SHA-256 collision)."""
    many = stage(groups.where("size > 1").select("digest"), "dedup-many")
    if many.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        many = F.broadcast(many)
    texts = normalised(docs, [], keep_text=True).join(many, "digest", "left_semi")
    unequal = (texts.groupBy("digest").agg(F.min("norm").alias("a"), F.max("norm").alias("b"))
               .where("a <> b").select(F.hex("digest").alias("digest")).limit(5).collect())
    if unequal:
        raise ValueError(f"different texts under one SHA-256: {[r[0] for r in unequal]}")


def half_of_ids():
    """The query's split of one table: half of the ids are the snapshot, the
    other half (and rows without an id) the incoming batch."""
    return F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0, F.lit(False))


def exact_duplicates(docs: DataFrame, in_snapshot=None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (largest doc_id of the equal
    texts), group_size, kept, text_sha256 of the normalised text.

    Null texts equal empty ones.  A null doc_id is smaller than any other; rows
    without one are kept only if their whole group has none.  If several rows
    carry the staying doc_id (repeated rows), one of them is kept.  Other
    columns are ignored; an empty table gives no rows.
    """
    in_snapshot = half_of_ids() if in_snapshot is None else in_snapshot
    rows = stage(normalised(docs.select(F.col("doc_id").cast("long"), "text"), ["doc_id"])
                 .withColumn("_row", F.monotonically_increasing_id()), "dedup-rows")
    groups = dedup_groups(docs, in_snapshot, rows)
    named = rows.join(groups, "digest").withColumn("staying", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    # repeated rows of a staying id: the first of them stays
    firsts = (named.where("staying and n_keep > 1").groupBy("digest").agg(F.min("_row").alias("_first"))
              .withColumnRenamed("digest", "_d"))
    named = named.join(firsts, named.digest == firsts._d, "left")
    return named.select(
        "doc_id", "keep_id", F.col("size").alias("group_size"),
        (F.col("staying") & ((F.col("n_keep") == 1) | F.col("_row").eqNullSafe(F.col("_first")))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, in_snapshot=None) -> DataFrame:
    """Rows of ``docs``, all columns, that stay (see ``exact_duplicates``)."""
    found = stage(exact_duplicates(docs, in_snapshot), "dedup-found")
    if found.where("doc_id is null").limit(1).count() or found.where("not kept and doc_id = keep_id").limit(1).count():
        # rows without an id of their own: told apart by their text instead
        return _drop_by_text(docs, found)
    gone = stage(found.where("not kept").select("doc_id"), "dedup-gone")
    if found.where("kept").join(gone, "doc_id", "left_semi").limit(1).count():
        return _drop_by_text(docs, found)  # an id of several texts, some of which stay
    return without_ids(docs, gone)


def _drop_by_text(docs: DataFrame, found: DataFrame) -> DataFrame:
    own, digest, keep = free_names(docs, "_digest", "_staying", "_keep")
    stays = found.where("kept").select(F.unhex("text_sha256").alias(digest), F.col("doc_id").alias(keep))
    rows = docs.withColumn(own, F.unhex(F.sha2(F.translate(
        F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), 256)))
    rows = rows.join(stays, (F.col(own) == F.col(digest)) & F.col("doc_id").cast("long").eqNullSafe(F.col(keep)))
    return rows.dropDuplicates([own]).drop(own, digest, keep)

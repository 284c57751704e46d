"""SimHash near-dedup by deletion-variant signatures.

A 64-bit fingerprint has two 32-bit segments.  Two fingerprints at most three
bits apart have a segment that differs in at most one bit, so they share that
segment with one bit struck out (a wildcard).  Every distinct fingerprint is
indexed under its one-wildcard segment variants plus its whole segments; equal
variants meet in one shuffle and are verified by the bit count of their xor.

Inside a bucket rows lie sorted, and only verified links leave it: a linked
set of 64-bit values of diameter three is small, so links stay near-linear.
Copies share a fingerprint and are merged before the index.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bedflow.llm.common import components, map_arrow, named, stage, without_ids

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: A bucket with more fingerprints than this is split by bytes of the other segment before comparing.
SPLIT = 256
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes | None, width: int = SHINGLE) -> int:
    """SimHash of one text's bytes as an unsigned integer; no words: 0."""
    words = (text or b"").translate(_TABLE).split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(width, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate(([0], np.cumsum(sizes[:-1] + 1)))
    ends = (starts + sizes)[k - 1:].tolist()
    starts = starts[: len(words) - k + 1].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for a in range(0, len(starts), 1 << 16):  # bounds the memory of a very long text
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[a:a + 65536], ends[a:a + 65536])], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for every row of (doc_id, text); fp as a signed long.  A
    null or empty text has fingerprint zero."""
    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
        return pa.record_batch([b.column(0), pa.array(fps)], names=["doc_id", "fp"])
    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")),
                     batch, "doc_id long, fp long")


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def _links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> list[np.ndarray]:
    """Verified links among rows sorted by key that share a key."""
    found = []
    step = 1
    while step < len(key):
        same = key[step:] == key[:-step]
        if not same.any():
            break
        i = np.flatnonzero(same)
        near = _popcount(fp[i] ^ fp[i + step]) <= max_bits
        i = i[near]
        found.append(np.stack((fp[i], fp[i + step], key[i])))
        step += 1
    return found


def _bucket_links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> np.ndarray:
    """Links of whole buckets.  A large bucket is first cut by each byte of the
    other segment: at most three of its four bytes can differ, so no link is lost."""
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(key)])))
    large = np.repeat(sizes > SPLIT, sizes)
    found = _links(key[~large], fp[~large], max_bits)
    if large.any():
        k, f = key[large], fp[large]
        other = np.where((k >> np.uint64(39)) == 0, f >> np.uint64(32), f) & np.uint64(0xFFFFFFFF)
        for shift in (0, 8, 16, 24):
            byte = (other >> np.uint64(shift)) & np.uint64(255)
            order = np.lexsort((f, byte, k))
            ks, bs, fs = k[order], byte[order], f[order]
            run = np.cumsum(np.concatenate(([0], (ks[1:] != ks[:-1]) | (bs[1:] != bs[:-1])))).astype(np.uint64)
            for part in _links(run, fs, max_bits):
                part[2] = ks[np.searchsorted(run, part[2])]
                found.append(part)
    if not found:
        return np.zeros((2, 0), np.uint64)
    a, b, k = np.concatenate(found, axis=1)
    # a link is told once a segment: by the variant that strikes the differing bit, or by the whole segment
    second, wild = (k >> np.uint64(39)) == 1, (k >> np.uint64(32)) & np.uint64(127)
    diff = np.where(second, (a ^ b) >> np.uint64(32), (a ^ b) & np.uint64(0xFFFFFFFF))
    struck = np.where(wild < 32, np.uint64(1) << np.minimum(wild, 31).astype(np.uint64), np.uint64(0))
    keep = diff == struck
    return np.stack((a[keep], b[keep]))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """All pairs (src, dst) of distinct fingerprints ``fps`` (fp) at most
    ``max_bits`` (up to three) apart; a pair may repeat."""
    if max_bits > 3:
        raise ValueError("two segments with one wildcard find links of at most three bits")
    variants = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("v")).select("fp", F.expr("""
        shiftleft(cast(v div 33 as bigint), 39) | shiftleft(cast(v % 33 as bigint), 32)
        | ((if(v < 33, fp, shiftrightunsigned(fp, 32)) & 4294967295L)
           & ~if(v % 33 < 32, shiftleft(1L, cast(v % 33 as int)), 0L))""").alias("key"))
    dealt = variants.repartition("key").sortWithinPartitions("key")

    def run(batches):
        key, fp = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        for b in batches:
            key = np.concatenate((key, b.column(0).to_numpy().view(np.uint64)))
            fp = np.concatenate((fp, b.column(1).to_numpy().view(np.uint64)))
            last = np.searchsorted(key, key[-1]) if len(key) else 0  # the last bucket may go on in the next batch
            if last >= 100_000:
                yield emit(key[:last], fp[:last])
                key, fp = key[last:], fp[last:]
        if len(key):
            yield emit(key, fp)

    def emit(key, fp):
        a, b = _bucket_links(key, fp, max_bits)
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["src", "dst"])

    return dealt.select("key", "fp").mapInArrow(run, "src long, dst long")


def near_groups(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    Null texts count as empty; empty texts share fingerprint zero and link like
    any other.  Rows without a doc_id get a component but never name one (a
    component of such rows only has a null id).  Repeated rows repeat.
    Other columns are ignored.  No rows: no rows.
    """
    rows = stage(fingerprints(docs), "simhash-rows")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-nodes")
    comps = stage(components(links(nodes.select("fp"), max_bits), "simhash"), "simhash-components")
    # nodes without a link are their own component
    named = nodes.join(comps, nodes.fp == comps.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component"))
    named = named.join(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "component")
    out = rows.join(named.select("fp", "component_id"), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows of ``docs``, all columns, without those whose doc_id is not the
    smallest of its component.  Rows without a doc_id stay; rows that share the
    staying doc_id all stay.  Rows of one doc_id with different texts stay or
    go each by its own component."""
    groups = stage(near_groups(docs, max_bits), "simhash-groups")
    gone = stage(groups.where("doc_id <> component_id").select("doc_id", "fingerprint").distinct(), "simhash-gone")
    if not groups.where("doc_id = component_id").join(gone, "doc_id", "left_semi").limit(1).count():
        return without_ids(docs, gone.select("doc_id"))

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
        return pa.record_batch([b.column(0), pa.array(fps)], names=["row", "fp"])
    packed = docs.select(F.struct(*map(named, docs.columns)).alias("row"), F.col("text").cast("binary").alias("bytes"))
    rows = map_arrow(packed, batch, T.StructType([packed.schema["row"], T.StructField("fp", T.LongType())]))
    kept = rows.join(gone, (F.col("row.doc_id").cast("long") == F.col("doc_id"))
                     & (F.lower(F.lpad(F.hex("fp"), 16, "0")) == F.col("fingerprint")), "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])

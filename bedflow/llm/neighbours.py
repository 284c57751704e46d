"""Approximate nearest neighbours by collision-counting hashing (query-aware).

Inner products are searched as distances: every vector gets one more
coordinate that brings it to the norm of the largest one; queries get zero
there and are scaled to that norm, which changes no order.  The nearest by
distance is then the largest by inner product.  Each
hash function is one random projection, kept as a sorted array.  A query's
window on an array is centred on its own projection; virtual rehashing widens
all windows by a factor round after round.  A vector inside the windows of at
least ``THRESHOLD`` of the arrays is a candidate and is verified by its exact
inner product.  A query stops once it has verified enough candidates.

The vectors are dealt over blocks and the queries over chunks.  A task holds
the arrays of one block, answers one chunk of queries and returns its best
``k`` of each, so neither side of a task grows with the table; an aggregation
per query merges the blocks.  Every vector is indexed, and every query asks
every block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedflow.llm.common import stage

K = 20
QUERY_EVERY = 20
PROJECTIONS = 64
#: Share of the arrays whose windows must hold a candidate.
THRESHOLD = 0.8
#: Vectors of a block, about.
BLOCK = 16_384
#: Queries of a chunk, about.
CHUNK = 16_384
#: A query verifies at least k plus this share of a block, and at least LEAST vectors of it.
SHARE = 0.15
LEAST = 600
#: Growth of the windows a round.
GROWTH = 1.15
SEED = 11


def _valid(vec: Column) -> Column:
    """Vectors that take part: no null, NaN or infinite component, and not all zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vec.isNotNull() & ~bad & F.exists(vec, lambda x: x != 0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


class Block:
    """Sorted projections of one block's vectors."""

    def __init__(self, vectors: np.ndarray, norm: float, projections: int = PROJECTIONS, seed: int = SEED) -> None:
        self.vectors, self.norm = vectors, norm
        n, dims = vectors.shape
        rng = np.random.default_rng(seed)
        self.axes = rng.standard_normal((dims + 1, projections))
        lift = np.sqrt(np.maximum(norm * norm - np.einsum("ij,ij->i", vectors, vectors), 0.0))
        at = vectors @ self.axes[:-1] + lift[:, None] * self.axes[-1]
        order = np.argsort(at, axis=0, kind="stable").T
        sorted_at = np.take_along_axis(at.T, order, axis=1)
        # all arrays in one: each is shifted beyond the one before, and cut at a window that spans everything
        self.reach = float(np.abs(at).max(initial=0.0)) + norm * float(np.abs(self.axes).sum(0).max()) + 1.0
        self.shift = 4 * self.reach * np.arange(projections)
        self.sorted, self.order = (sorted_at + self.shift[:, None]).ravel(), order.ravel()
        # half a window's width at first; later queries start one step below what the last one needed
        self.half = max(float(at.std(axis=0).mean()), 1e-9) / math.sqrt(max(n, 1))

    def candidates(self, query: np.ndarray, wanted: int) -> np.ndarray:
        """Numbers of the vectors that collide with ``query`` often enough."""
        n, m = len(self.vectors), len(self.shift)
        if n <= wanted:
            return np.arange(n)
        at = query * (self.norm / math.sqrt(query @ query)) @ self.axes[:-1] + self.shift
        need = max(1, math.ceil(THRESHOLD * m))
        hits = np.zeros(n, np.int64)
        low = high = np.searchsorted(self.sorted, at)
        half = self.half
        while True:
            half = min(half, 2 * self.reach)
            lo = np.minimum(np.searchsorted(self.sorted, at - half), low)
            hi = np.maximum(np.searchsorted(self.sorted, at + half, "right"), high)
            # only what the widened windows gain; a vector is in an array once
            if low is not high:
                hits += self._count(lo.tolist() + high.tolist(), low.tolist() + hi.tolist())
            elif 2 * int((hi - lo).sum()) <= m * n:
                hits += self._count(lo.tolist(), hi.tolist())
            else:  # first windows of more than half the arrays: count what lies outside
                edges = np.arange(m + 1) * n
                hits += m - self._count(edges[:-1].tolist() + hi.tolist(), lo.tolist() + edges[1:].tolist())
            low, high = lo, hi
            found = np.flatnonzero(hits >= need)
            if len(found) >= wanted or half >= 2 * self.reach:
                self.half = half / GROWTH
                return found
            half *= GROWTH

    def _count(self, starts: list[int], ends: list[int]) -> np.ndarray:
        """How often each vector occurs in the slices of the arrays."""
        parts = [self.order[a:b] for a, b in zip(starts, ends)]
        return np.bincount(np.concatenate(parts), minlength=len(self.vectors))

    def nearest(self, query: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: int,
                k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the best ``k`` candidates but the row ``own``."""
        wanted = max(LEAST, k + 1 + math.ceil(SHARE * len(self.vectors)))
        c = self.candidates(query, wanted)
        c = c[rows[c] != own]
        score = np.einsum("ij,j->i", self.vectors[c], query)  # one order of addition for every row: copies tie exactly
        best = np.lexsort((ids[c], -score))[:k]
        return ids[c][best], score[best]


def dealt(rows: DataFrame, queries: DataFrame, blocks: int, chunks: int) -> tuple[DataFrame, DataFrame]:
    """Every vector once a chunk (block, chunk, vec_id, embedding, row) and every
    query once a block (block, chunk, query_id, query, row)."""
    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    own = rows.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block"),
                      each(chunks).alias("chunk"), "vec_id", "embedding", "row")
    # salted: a chunk's queries come from every block
    asked = queries.select(each(blocks).alias("block"),
                           F.pmod(F.xxhash64("row", F.lit(1)), F.lit(chunks)).cast("int").alias("chunk"),
                           "query_id", "query", "row")
    return own, asked


def nearest(vectors: DataFrame, is_query: Column, k: int = K, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best of each query.

    ``vectors`` has vec_id and embedding; other columns are ignored.  Rows with
    a null id, and vectors that are null, zero or hold null or non-finite
    components, take no part; nor do vectors of another length than the
    commonest.  Equal scores go to the smaller vec_id.  Rows that repeat a
    vec_id, or a whole row, are candidates and queries of their own; a query's own row only is left
    out.  Fewer candidates than ``k``: all of them; no rows: no
    rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & _valid(F.col("embedding"))).withColumn(
        "row", F.monotonically_increasing_id())
    rows = stage(rows.withColumn("norm2", F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)), "ann-vectors")
    sizes = rows.groupBy(F.size("embedding").alias("dims")).agg(
        F.count(F.lit(1)).alias("n"), F.max("norm2").alias("top")).orderBy(F.desc("n"), "dims").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("embedding") == sizes["dims"])
    norm, blocks = math.sqrt(sizes["top"]), max(1, math.ceil(sizes["n"] / block))
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"), "row")
    chunks = max(1, math.ceil(queries.count() / chunk))
    own_rows, asked_rows = dealt(rows, queries, blocks, chunks)

    def search(own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        asks, queried, ids, scores = [], [], [], []
        if len(own) and len(ask):
            index = Block(_matrix(own["embedding"]), norm)
            own_ids = own["vec_id"].to_numpy()
            own_rows_ = own["row"].to_numpy()
            for q, row, vec in zip(ask["query_id"].to_numpy(), ask["row"].to_numpy(), _matrix(ask["query"])):
                got, score = index.nearest(vec, own_ids, own_rows_, row, k)
                asks.append(np.full(len(got), q))
                queried.append(np.full(len(got), row))
                ids.append(got)
                scores.append(score)
        return pd.DataFrame({c: np.concatenate(x) if x else [] for c, x in (
            ("query_id", asks), ("row", queried), ("vec_id", ids), ("score", scores))})

    found = own_rows.groupBy("block", "chunk").cogroup(asked_rows.groupBy("block", "chunk")).applyInPandas(
        search, "query_id long, row long, vec_id long, score double")
    # each task passes on its own k best of a query before the shuffle
    order = Window.partitionBy("query_id", "row").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def every(n: int = QUERY_EVERY) -> Column:
    """The query rows: ids divisible by ``n``."""
    return F.col("vec_id") % n == 0

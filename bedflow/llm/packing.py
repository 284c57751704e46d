"""Best-fit packing of token sequences in bulk-synchronous rounds.

Documents are tokenised once; a document longer than the capacity is cut so
that only its first piece is short.  Pieces are range-sorted by length, and
every piece gets its rank among those of its length.  What is alike is one row:
pieces of a length are a run of ranks, gaps of a size a run of sequences.  So
the tables of a round have no more rows than lengths, sizes and rounds allow,
whatever the corpus holds.

Lengths come in bands, the longest first.  A round of a band is one Spark job over the
range-sorted runs of unplaced pieces and open gaps:

* successor sweep: from large to small, each run of pieces takes the smallest
  gaps seen that hold it, as many of its pieces a gap as go in.  Ranges of sizes are
  swept in parallel; what finds nothing in its range is swept over all of them;
* conflicts by rank: where gaps of a size are too few, the lower ranks win, and
  the others go on to the next larger gaps;
* gaps shrink, are written with what stays unplaced, and the next round follows.

If no open gap holds any unplaced piece of the band, sequences are opened: as
many as these pieces need at least, by their tokens and by how many of the shortest go into
one.  The driver sees one row a round.  Finally each piece finds its run by length and rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedflow.llm.common import class_ranks, discard, map_arrow, stage

CAPACITY = 2048
#: Runs beyond this many are joined by a shuffle instead of a broadcast.
BROADCAST_RUNS = 200_000
#: Bands of lengths: shares of the capacity, each band reaching down to the next one's top.
BANDS = (1, 1 / 2, 1 / 3, 1 / 4, 1 / 16)
#: Ranges of sizes that a round sweeps in parallel.
RANGES = 16

#: Rows of a round: open gaps (size, first sequence, n), unplaced pieces (length, first rank, n), gaps that
#: have shrunk in this round, and placed pieces (length, first rank, n; first sequence, pieces a sequence, offset).
GAP, PIECE, SHRUNK, PLACED = range(4)
RUNS = "kind int, size long, first long, n long, seq long, per long, offset long"


class Encoder:
    """Ids of the byte-level BPE vocabulary in a ``tokenizers`` file.

    The same vocabulary as ranks (``.tiktoken`` beside it) encodes several
    times faster with equal ids; a text that spells a special token goes to
    ``tokenizers`` itself, which reads it as that token.
    """

    _made: dict = {}

    def __init__(self, path: str) -> None:
        import base64
        import json
        import os

        self.path, self._slow, self.fast = path, None, None
        with open(path, encoding="utf-8") as f:
            self.special = [t["content"] for t in json.load(f)["added_tokens"]]
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(ranks):
            import public_tokenizers
            import tiktoken
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("byte-bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table,
                                          special_tokens={}).encode_ordinary

    @property
    def slow(self):
        """The library's own tokenizer, loaded when first needed."""
        if self._slow is None:
            from tokenizers import Tokenizer
            self._slow = Tokenizer.from_file(self.path)
        return self._slow

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._made:
            cls._made[path] = cls(path)
        return cls._made[path]

    def __call__(self, text: str) -> list[int]:
        if self.fast is None or any(s in text for s in self.special):
            return self.slow.encode(text, add_special_tokens=False).ids
        return self.fast(text)


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and the ids if asked
    for.  A null text counts as empty: one piece holding the closing id 0."""
    path = tokenizer or default_tokenizer()

    def batch(b: pa.RecordBatch) -> pa.RecordBatch:
        encode = Encoder.of(path)
        out: list[tuple] = []
        for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            ids = np.array([*encode(text or ""), 0], "<u4")
            first = len(ids) % capacity or capacity
            bounds = [0, *range(first, len(ids) + 1, capacity)]
            for k, (s, e) in enumerate(zip(bounds, bounds[1:])):
                out.append((doc, k, s, e - s, zlib.crc32(ids[s:e].tobytes()), ids[s:e] if with_ids else None))
        cols = list(zip(*out)) or [()] * 6
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        n = 6 if with_ids else 5
        return pa.record_batch([pa.array(list(c), k) for c, k in zip(cols[:n], kinds)], names=names[:n])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return map_arrow(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), batch, schema)


def plan_runs(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing length by length, in one process: what the rounds are
    measured against.  Rows (length, first rank, pieces, first sequence, offset),
    each placing equal pieces into as many neighbouring sequences."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, sequences)
    sizes: list[int] = []  # the open gaps, sorted
    runs, opened = [], 0

    def add(gap: int, first: int, n: int) -> None:
        if gap:
            if gap not in gaps:
                gaps[gap] = []
                insort(sizes, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(sizes, length)  # the successor: the smallest gap that holds the piece
            if at == len(sizes):
                # none does: open as many sequences as these pieces fill
                fresh = -(-left // (capacity // length))
                add(capacity, opened, fresh)
                opened += fresh
                continue
            gap = sizes[at]
            first, n = gaps[gap].pop()
            take = min(n, left)
            if take < n:
                gaps[gap].append((first + take, n - take))
            if not gaps[gap]:
                del gaps[gap]
                sizes.pop(at)
            runs.append((length, rank, take, first, capacity - gap))
            add(gap - length, first, take)
            rank, left = rank + take, left - take
    return runs


def sweep(rows: Iterable[tuple], capacity: int = CAPACITY) -> list[tuple]:
    """One successor sweep over the gaps and pieces of ``rows`` (as in ``RUNS``):
    the same rows after it.  A gap is used once; what is left of it is SHRUNK,
    for the next round.  Other kinds of rows are handed on.

    From large to small, the gaps seen and not used lie on a stack, the smallest
    on top: the top is the successor of the next run of pieces.
    """
    out, events, stack = [], [], []
    for row in rows:
        (events if row[0] in (GAP, PIECE) else out).append(row)
    for kind, size, first, n, *_ in sorted(events, key=lambda r: (-r[1], r[0], r[2])):
        if kind == GAP:
            stack.append((size, first, n))
            continue
        while n and stack:
            gap, seq, gaps = stack.pop()
            per = gap // size
            used = min(gaps, -(-n // per))
            taken = min(n, used * per)
            out.append((PLACED, size, first, taken, seq, per, capacity - gap))
            full, rest = divmod(taken, per)
            if full and gap > per * size:
                out.append((SHRUNK, gap - per * size, seq, full, None, None, None))
            if rest:
                out.append((SHRUNK, gap - rest * size, seq + full, 1, None, None, None))
            if used < gaps:
                stack.append((gap, seq + used, gaps - used))
            first, n = first + taken, n - taken
        if n:
            out.append((PIECE, size, first, n, None, None, None))
    return out + [(GAP, *gap, None, None, None) for gap in stack]


def _swept(runs: DataFrame, capacity: int) -> DataFrame:
    """``sweep`` over all ``runs``: first inside ranges of sizes, then over what
    found nothing there, which gives the same matches."""
    names = [c.split()[0] for c in RUNS.split(", ")]

    def step(group: pd.DataFrame) -> pd.DataFrame:
        rows = group[names].astype(object).itertuples(index=False, name=None)
        swept = pd.DataFrame(sweep(rows, capacity), columns=names)
        return swept.astype({c: "Int32" if c == "kind" else "Int64" for c in names})
    part = F.floor((F.col("size") - 1) * RANGES / capacity)
    inside = runs.groupBy(part.alias("part")).applyInPandas(step, RUNS)
    return inside.groupBy(F.when(F.col("kind").isin(GAP, PIECE), -1).otherwise(part).alias("part")
                          ).applyInPandas(step, RUNS)


def place_runs(counts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rounds over ``counts`` (length, n; staged): staged rows length,
    first_rank, n, first_seq, per, offset, each placing n equal pieces, ``per``
    to a sequence.  No rows: no rows."""
    spark = counts.sparkSession
    none = [F.lit(None).cast("long").alias(c) for c in ("seq", "per", "offset")]
    state, rounds, opened = spark.createDataFrame([], RUNS), [], 0
    tops = [int(capacity * share) for share in BANDS]
    kind, size, n = F.col("kind"), F.col("size"), F.col("n")
    open_gap, unplaced = kind.isin(GAP, SHRUNK), kind == PIECE
    for top, bottom in zip(tops, [*tops[1:], 0]):
        band = counts.where((F.col("length") <= top) & (F.col("length") > bottom)).select(
            F.lit(PIECE).alias("kind"), F.col("length").alias("size"), F.lit(0).cast("long").alias("first"), "n", *none)
        runs = state.where(open_gap).withColumn("kind", F.lit(GAP)).unionByName(band)
        while True:
            largest, least, many, tokens = runs.agg(
                F.max(F.when(open_gap, size)), F.min(F.when(unplaced, size)), F.sum(F.when(unplaced, n)),
                F.sum(F.when(unplaced, n * size))).first()
            if not many:
                break
            if largest is None or largest < least:
                more = max(-(-tokens // capacity), -(-many // (capacity // least)))
                fresh = spark.range(1).select(F.lit(GAP).alias("kind"), *[F.lit(x).cast("long").alias(c) for c, x in (
                    ("size", capacity), ("first", opened), ("n", more))], *none)
                runs, opened = runs.unionByName(fresh), opened + more
            state = stage(_swept(runs, capacity), "packing-round")
            rounds.append(state)
            runs = state.where(open_gap | unplaced).withColumn("kind", F.when(unplaced, PIECE).otherwise(GAP))
    if rounds:
        state = spark.read.schema(RUNS).parquet(*[r.staged_at for r in rounds])
    placed = state.where(kind == PLACED).select(size.alias("length"), F.col("first").alias("first_rank"), "n",
                                                F.col("seq").alias("first_seq"), "per", "offset")
    placed = stage(placed, "packing-runs")
    discard(*rounds)
    return placed


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Staged ``parts`` (doc_id, piece, length, ...) plus sequence_id and offset.

    Equal lengths are ordered by (doc_id, piece).  No rows: no rows.
    """
    ranked = class_ranks(parts, ["length"], ["doc_id", "piece"], "packing-ranks")
    # at most `capacity` rows: one a length
    counts = stage(parts.groupBy("length").agg(F.count(F.lit(1)).alias("n")), "packing-lengths")
    plan = place_runs(counts, capacity)
    if plan.limit(BROADCAST_RUNS + 1).count() <= BROADCAST_RUNS:
        plan = F.broadcast(plan)
    place = F.col("class_rank") - F.col("first_rank")
    inside = (place >= 0) & (place < F.col("n"))
    placed = ranked.join(plan.withColumnsRenamed({"length": "_length", "offset": "_offset"}),
                         (F.col("length") == F.col("_length")) & inside)
    return placed.select(*parts.columns, (F.col("first_seq") + F.floor(place / F.col("per"))).alias("sequence_id"),
                         (F.col("_offset") + F.pmod(place, "per") * F.col("length")).alias("offset"))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Per piece of every row of ``docs`` (doc_id, text; others ignored):
    doc_id, piece, start, length, ids_crc32, sequence_id, offset.  Repeated
    rows and rows without a doc_id are packed like any other."""
    return pack(stage(pieces(docs, capacity, tokenizer), "packing-pieces"), capacity)

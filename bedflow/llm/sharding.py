"""Minimum-cost-flow resharding under the law "rows": new shards differ by at
most one row, and the rows that move weigh as few bytes as possible.

An old shard with more rows than its new capacity gives its smallest rows
away.  Rows are ranked by size inside their old shard (a range sort), and each
old shard is summed up into at most ``BLOCKS`` blocks of neighbouring ranks.
The flow network has an old shard's blocks on one side and the new shards on
the other; staying is free, moving costs a block's bytes a row, and the spare
rows of an uneven division are capacities any shard may take.  The network's
size depends on the numbers of shards and blocks only; the solution is a list
of rank intervals, which Spark applies to the rows.  The files of every shard
that gains or loses rows are then written anew; a row key tells rows apart.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bedflow.llm.common import class_ranks, free_names, named, place_ranks, sorted_places, stage
from bedflow.session import shared_dir

SHARDS = 24
OLD_SHARDS = 16
#: Blocks an old shard is summed up into.
BLOCKS = 64
#: Key of a row of a laid out table; doc_ids may be null or repeated.
ROW = "_row"
#: What rows are ranked by inside an old shard.
ORDER = ["size", "doc_id", "text_crc32"]
#: Names that the layout's files and steps use.
OWN = frozenset(["shard", "old_shard", ROW, "_place", "_old", "_new", "_from", "_low", "_high", "_doc_id", "_size",
                 "_text_crc32", "_id", "slot", "class_rank", "_part", "_k_shard", "_p", "_n", "_first", "_before"])


class Network:
    """Minimum-cost flow by successive shortest paths with potentials."""

    def __init__(self) -> None:
        self.arcs: list[list] = []  # [to, capacity left, cost]; arc i ^ 1 is the reverse of arc i
        self.out: dict[object, list[int]] = {}

    def add(self, a, b, capacity: int, cost: float) -> int:
        for node, arc in ((a, [b, capacity, cost]), (b, [a, 0, -cost])):
            self.out.setdefault(node, []).append(len(self.arcs))
            self.arcs.append(arc)
        return len(self.arcs) - 2

    def flow(self, i: int) -> int:
        return self.arcs[i ^ 1][1]

    def run(self, source, sink) -> None:
        height = dict.fromkeys(self.out, 0.0)  # no arc has a negative cost at the start
        while True:
            far, came = {source: 0.0}, {}
            heap, n, done = [(0.0, 0, source)], 0, set()
            while heap:
                d, _, a = heapq.heappop(heap)
                if a in done:
                    continue
                done.add(a)
                for i in self.out[a]:
                    b, left, cost = self.arcs[i]
                    if left and b not in done:
                        e = d + max(0.0, cost + height[a] - height[b])
                        if e < far.get(b, float("inf")):
                            far[b], came[b] = e, i
                            n += 1
                            heapq.heappush(heap, (e, n, b))
            if sink not in far:
                return
            for a in self.out:
                height[a] += far.get(a, far[sink])
            path, b = [], sink
            while b != source:
                path.append(came[b])
                b = self.arcs[came[b] ^ 1][0]
            push = min(self.arcs[i][1] for i in path)
            for i in path:
                self.arcs[i][1] -= push
                self.arcs[i ^ 1][1] += push


@dataclass(frozen=True)
class Move:
    """Rows [first, first + n) by rank of an old shard go to ``shard``, from
    ``slot`` on; ``first`` counts from the old shard's smallest row."""
    old: int
    first: int
    n: int
    shard: int
    slot: int


def solve(blocks: dict[int, list[tuple[int, int]]], shards: int = SHARDS) -> list[Move]:
    """Transfers from ``blocks`` (old shard -> (rows, bytes) of its blocks,
    smallest rows first) to shards 0 .. shards - 1.  The rows that stay have
    the highest ranks."""
    if not blocks:
        return []
    have = {i: sum(n for n, _ in b) for i, b in blocks.items()}
    total = sum(have.values())
    least, spare = divmod(total, shards)
    net = Network()
    stays, leaves, comes = {}, {}, {}
    for i, own in blocks.items():
        for k, (n, size) in enumerate(own):
            net.add("source", ("block", i, k), n, 0.0)
            if i < shards:
                net.add(("block", i, k), ("old", i), n, 0.0)
            net.add(("block", i, k), ("leaving", i), n, size / max(n, 1))
        if i < shards:
            stays[i] = net.add(("old", i), ("new", i), have[i], 0.0)
        leaves[i] = net.add(("leaving", i), "pool", have[i], 0.0)
    for j in range(shards):
        comes[j] = net.add("pool", ("new", j), total, 0.0)
        net.add(("new", j), "sink", least, 0.0)
        net.add(("new", j), "spare", 1, 0.0)
    net.add("spare", "sink", spare, 0.0)
    net.run("source", "sink")

    moves = []
    for i in stays:
        if net.flow(stays[i]):
            moves.append(Move(i, have[i] - net.flow(stays[i]), net.flow(stays[i]), i, 0))
    wanted = [[j, net.flow(comes[j]), net.flow(stays[j]) if j in stays else 0] for j in range(shards)]
    wanted = [w for w in wanted if w[1]]
    for i in sorted(leaves):
        first, left = 0, net.flow(leaves[i])
        while left:
            j, room, slot = wanted[-1]
            n = min(room, left)
            moves.append(Move(i, first, n, j, slot))
            first, left = first + n, left - n
            if n == room:
                wanted.pop()
            else:
                wanted[-1][1:] = [room - n, slot + n]
    return moves


def _measures() -> list[Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32")]


def _key(docs: DataFrame) -> list[str]:
    return [ROW] if ROW in docs.columns else []


def sized(docs: DataFrame, old_shard: Column) -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text plus 8; null text: 8), text_crc32
    and the old shard of every row, and its key if it has one."""
    return docs.select(*_measures(), old_shard.cast("int").alias("old_shard"), *_key(docs))


def by_source() -> Column:
    """The layout that the query starts from: documents lie by their source,
    whose busiest holds a third of all rows."""
    return F.crc32(F.coalesce(F.col("source").cast("string"), F.lit(""))) % OLD_SHARDS


def reshard(docs: DataFrame, old_shard: Column | None = None, shards: int = SHARDS, blocks: int = BLOCKS) -> DataFrame:
    """doc_id, size, text_crc32, law, old_shard, shard, slot, grown_shard for
    every row of ``docs``; ``old_shard`` is where a row lies now (0-based).

    Shards differ by at most one row, slots are gapless from 0 in each.  Rows
    of equal size are ranked by doc_id and checksum, a null doc_id first;
    repeated rows are rows like any other.  ``grown_shard`` is null: it belongs
    to the law "key".  The key of laid out rows is kept.  Other columns are
    ignored; no rows: no rows.
    """
    rows = stage(sized(docs, by_source() if old_shard is None else old_shard), "reshard-rows")
    ranked = stage(class_ranks(rows, ["old_shard"], [*ORDER, *_key(docs)], "reshard-ranks"), "reshard-ranked")
    totals = ranked.groupBy("old_shard").agg(F.count(F.lit(1)).alias("rows"))  # one row an old shard
    cut = ranked.join(F.broadcast(totals.withColumnRenamed("old_shard", "_o")), F.col("old_shard") == F.col("_o"))
    summed = cut.groupBy("old_shard", F.expr(f"class_rank * {blocks} div rows").alias("block")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    layout: dict[int, list[tuple[int, int]]] = {}
    for r in sorted(summed.collect()):  # old shards x blocks rows at most
        layout.setdefault(r[0], []).append((r["n"], r["bytes"]))
    moves = solve(layout, shards)
    spark: SparkSession = docs.sparkSession
    plan = F.broadcast(spark.createDataFrame([(m.old, m.first, m.n, m.shard, m.slot) for m in moves],
                                             "old int, first long, n long, shard int, from_slot long"))
    placed = ranked.join(plan, (F.col("old_shard") == F.col("old")) & (F.col("class_rank") >= F.col("first"))
                         & (F.col("class_rank") < F.col("first") + F.col("n")))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         (F.col("from_slot") + F.col("class_rank") - F.col("first")).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), "old_shard", *_key(docs))


def lay_out(docs: DataFrame, old_shard: Column, path: str) -> DataFrame:
    """Write ``docs``, all columns, to ``path``/shard=N as they lie now, each
    row with a key, and read them back.  Columns called like one of the
    layout's own (``OWN``, in any case) get underscores behind their name."""
    lies, = free_names(docs, "_lies")
    names, taken = [], {c.lower() for c in docs.columns} | OWN
    for c in docs.columns:
        new = c
        while new.lower() in OWN or (new != c and new.lower() in taken):
            new += "_"
        taken.add(new.lower())
        names.append(new)
    docs = docs.withColumn(lies, old_shard.cast("int")).toDF(*names, lies)
    rows = docs.withColumn(ROW, F.monotonically_increasing_id()).withColumnRenamed(lies, "shard").select(*map(named, names), ROW, "shard")
    rows.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(rows.schema).parquet(path)


def _moved(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """Laid out ``docs`` in the order of their new shards and slots, with
    ``_place``.  The rows that go from one shard to another are neighbours by
    rank, so the first and last of them tell which rows go: one line a pair of
    shards, and no join moves a text."""
    key = [*ORDER, ROW]
    ends = placed.groupBy(F.col("old_shard").alias("_old"), F.col("shard").alias("_new")).agg(
        F.min("slot").alias("_from"), F.min(F.struct(*key)).alias("_low"), F.max(F.struct(*key)).alias("_high"))
    own = F.struct(*[F.col(f"_{c}") for c in ORDER], F.col(ROW))
    rows = docs.withColumns(dict(zip(("_doc_id", "_size", "_text_crc32"), _measures())))
    rows = rows.join(F.broadcast(ends), (F.col("shard") == F.col("_old")) & (own >= F.col("_low"))
                     & (own <= F.col("_high")))
    rows = sorted_places(rows, ["_new", "_from", *[f"_{c}" for c in ORDER], ROW])
    return rows.select(*[named(c) for c in docs.columns if c != "shard"], "_place", F.col("_old").alias("old_shard"),
                       F.col("_new").alias("shard"))


def rewrite(docs: DataFrame, placed: DataFrame, path: str) -> list[int]:
    """Write the shards that gain or lose rows to ``path``/shard=N and return
    them; a shard left without rows is removed.  A shard whose rows all stay
    keeps its files and is not written.

    ``docs`` are the rows that ``placed`` was made from, laid out at ``path``
    or elsewhere; ``slots`` tells the slots of what is written.  Rows that were
    not laid out have no key and need doc_ids that are unique and not null.
    Only rows of affected shards are shuffled.
    """
    changed = placed.where("shard <> old_shard")
    # at most one row a shard
    affected = sorted(r[0] for r in changed.select("shard").union(changed.select("old_shard")).distinct().collect())
    todo = placed.where(F.col("shard").isin(affected))
    if ROW in docs.columns:
        rows = _moved(docs.where(F.col("shard").isin(affected)), todo)
    else:
        ids = docs.groupBy(F.col("doc_id").cast("long").alias("_id")).count()
        if ids.where("_id is null or count > 1").limit(1).count():
            raise ValueError("doc_ids are null or repeated: lay the rows out first")
        todo = stage(todo.select(F.col("doc_id").alias("_id"), "shard", "slot"), "reshard-todo")
        rows = docs.join(todo, F.col("doc_id").cast("long") == F.col("_id")).drop("_id")
        rows = sorted_places(rows, ["shard", "slot"])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(
        "shard").parquet(path)
    filled = {r[0] for r in todo.select("shard").distinct().collect()}
    spark = docs.sparkSession
    for shard in affected:
        if shard not in filled:
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/shard={shard}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return affected


def slots(rows: DataFrame) -> DataFrame:
    """Rows of rewritten shards with their ``slot``, the place in their shard's files."""
    return place_ranks(rows, ["shard"]).withColumn("slot", F.col("class_rank")).drop(
        "class_rank", "_part", "_place", "_k_shard", "_p", "_first", "_before")


def reshard_files(docs: DataFrame, old_shard: Column | None = None, shards: int = SHARDS,
                  blocks: int = BLOCKS) -> DataFrame:
    """The whole job: lay ``docs`` out in the shared folder by ``old_shard``,
    solve, and rewrite the affected files in place.  The columns of ``reshard``
    for every row, taken from the files as they are then; the slots in shards
    that keep their files come from the plan.  Null texts stay null in the files
    (size 8); null and repeated doc_ids are rows like any other; no rows: no
    rows.  Other columns are laid out too, under longer names where the layout
    needs theirs."""
    spark: SparkSession = docs.sparkSession
    path = f"{shared_dir(spark)}/reshard-files-{uuid.uuid4().hex}"
    old = lay_out(docs, by_source() if old_shard is None else old_shard, path)
    placed = stage(reshard(old, F.col("shard"), shards, blocks), "reshard-placed")
    affected = rewrite(old, placed, path)
    extra = [T.StructField("_place", T.LongType()), T.StructField("old_shard", T.IntegerType())]
    back = spark.read.schema(T.StructType([*old.schema.fields, *extra])).parquet(path)
    written = F.col("shard").isin(affected)
    kept = placed.where(~written).select(F.col(ROW).alias("_id"), "slot")
    kept = back.where(~written).join(kept, F.col(ROW) == F.col("_id")).withColumn("old_shard", F.col("shard"))

    def told(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(*_measures(), F.lit("rows").alias("law"), "shard", *more,
                           F.lit(None).cast("int").alias("grown_shard"), "old_shard")
    return slots(told(back.where(written), "_place")).unionByName(told(kept, "slot")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", "old_shard")

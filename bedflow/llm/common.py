"""Helpers shared by the operators: staged tables, ranks inside classes after
a range sort, and distributed connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedflow.sources.sinks import discard, stage

__all__ = ["class_ranks", "components", "discard", "free_names", "joined_components", "map_arrow", "named", "place_ranks",
           "sorted_places", "stage", "text_hash", "without_ids", "without_texts"]

#: Id lists up to this many rows (8 bytes each) may be broadcast; beyond it the join shuffles.
BROADCAST_IDS = 200_000
#: Rows of a record batch that are turned into Python objects together.
SLICE = 1000


def map_arrow(df: DataFrame, per_batch: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function from one record batch to one.  Batches
    are handed over in slices, so that Python holds few rows at a time."""
    size = SLICE

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), size):
                yield per_batch(batch.slice(at, size))
    return df.mapInArrow(run, schema)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The ``wanted`` column names, with as many underscores behind as make
    them new in ``df`` (names do not differ by case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def named(name: str) -> Column:
    """The column of exactly this name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_hash(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def without_texts(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, whose doc_id (null included) and text are
    not in ``dropped`` (staged, distinct: doc_id, and t as of ``text_hash``).
    Rows that share a doc_id go or stay each by its own text.  The list is
    broadcast only if a count shows that it is small."""
    if dropped.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        dropped = F.broadcast(dropped)
    i, t = free_names(docs, "_gone_id", "_gone_t")
    gone = dropped.select(F.col("doc_id").alias(i), F.col("t").alias(t))
    return docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(i)) & (text_hash() == F.col(t)), "left_anti")


def without_ids(df: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``df`` whose ``key`` is not in ``dropped`` (staged, distinct ids).
    The id list is broadcast only if a count shows that it is small."""
    if dropped.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        dropped = F.broadcast(dropped)
    return df.join(dropped, key, "left_anti")


def class_ranks(df: DataFrame, classes: list[str], order: list[str], label: str) -> DataFrame:
    """Adds ``class_rank`` (0-based, gapless) of every row inside its class, in
    ``order``.

    A range sort on (classes, order) deals a large class over many partitions;
    the sorted table is staged with each row's partition and place, and a rank
    is the rows of the class in earlier partitions plus the place in its own.
    Only a (partition, class) table of counts is summed up, never the rows.
    Reads ``df`` twice (the range sort samples it), so pass a staged table.
    """
    placed = stage(sorted_places(df, [*classes, *order]), label)
    return place_ranks(placed, classes).select(*df.columns, "class_rank")


def sorted_places(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` range-sorted by ``order``, with each row's ``_place``."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = [F.col(c) for c in order]
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn(
        "_place", F.monotonically_increasing_id())


def place_ranks(placed: DataFrame, classes: list[str]) -> DataFrame:
    """Adds ``class_rank`` to written rows that hold their ``_place``."""
    placed = placed.withColumn("_part", F.shiftright("_place", 33).cast("int"))
    counts = placed.groupBy("_part", *classes).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    before = Window.partitionBy(*classes).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a class has one row a partition here, however many rows it has
    offsets = counts.select(*[F.col(c).alias(f"_k_{c}") for c in classes], F.col("_part").alias("_p"), "_first",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in classes]
    out = placed.join(offsets, [*same, F.col("_p") == F.col("_part")])
    return out.withColumn("class_rank", F.col("_before") + F.col("_place") - F.col("_first"))


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of undirected ``edges`` (src, dst): rows
    (node, component) for every node of an edge; component = smallest node.

    Alternating large-star and small-star rounds until the edges are a star
    around each component's smallest node.  Neighbour minima are aggregates
    that combine map-side, so a hub costs no more than its edges; each round is
    staged.
    """
    def oriented(a, b):
        return F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")

    def stars(t):
        """Whether every node has one edge down, or is where they end."""
        ends = t.select(F.explode(F.array(F.struct(F.col("src").alias("node"), F.lit(1).alias("down")),
                                          F.struct(F.col("dst").alias("node"), F.lit(0).alias("down")))).alias("x"))
        nodes = ends.groupBy("x.node").agg(F.sum("x.down").alias("n"), F.min("x.down").alias("least"))
        return not nodes.where("n > 1 or (n = 1 and least = 0)").limit(1).count()

    e = stage(edges.where(F.col("src") != F.col("dst")).select(*oriented(F.col("src"), F.col("dst"))).distinct(),
              f"{label}-edges")
    while not stars(e):
        both = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = (both.where(F.col("dst") > F.col("src")).join(low, "src")
                 .select(F.col("dst").alias("src"), F.col("m").alias("dst")))
        down = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = (large.join(down, "src")
                 .select(F.explode(F.array(
                     F.struct("src", F.col("m").alias("dst")),
                     F.struct(F.col("dst").alias("src"), F.col("m").alias("dst")))).alias("e"))
                 .select("e.src", "e.dst").where(F.col("src") != F.col("dst")).distinct())
        done, e = e, stage(small, f"{label}-round")
        discard(done)
    roots = e.select(F.col("dst").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots)


def joined_components(comps: DataFrame, more: DataFrame, label: str) -> DataFrame:
    """Components ``comps`` (node, component) after adding the links ``more``
    (src, dst): only the components that the links touch are joined anew."""
    def root(df, name):
        c = comps.select(F.col("node").alias(name), F.col("component").alias("_c"))
        return df.join(c, name, "left").withColumn(name, F.coalesce("_c", name)).drop("_c")

    touched = stage(root(root(more, "src"), "dst").distinct(), f"{label}-touched")
    merged = stage(components(touched, label), f"{label}-merged")
    if not merged.limit(1).count():
        return comps
    merged = merged.select(F.col("node").alias("_n"), F.col("component").alias("_m"))
    moved = comps.join(merged, comps.component == F.col("_n"), "left").select(
        "node", F.coalesce("_m", "component").alias("component"))
    fresh = merged.select(F.col("_n").alias("node"), F.col("_m").alias("component")).join(comps, "node", "left_anti")
    return stage(moved.unionByName(fresh), f"{label}-components")

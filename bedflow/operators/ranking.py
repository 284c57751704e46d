"""Global positions and dense ranks without a window over all rows (W6).

Rows are dealt by ranges of the order, sorted inside their partition and
written with their place; a row's position is the rows of earlier partitions
plus its place in its own.  Only the counts (one row a partition) are summed up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bedflow.sources.sinks import stage

#: monotonically_increasing_id holds the partition above this bit.
PARTITION_BITS = 33


def positions(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """``df`` with each row's position, from 1, in ``order`` (nulls first; equal
    rows in any order).  Reads ``df`` twice (its ranges are sampled), so pass a
    staged table; the result is staged."""
    keys = [F.col(c) for c in order]
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = stage(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                   .withColumn("_place", F.monotonically_increasing_id()), "positions")
    placed = placed.withColumn("_range", F.shiftright("_place", PARTITION_BITS).cast("int"))
    # one row a partition: bounded by the number of shuffle partitions
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_add"))
    return (placed.join(F.broadcast(offsets), "_range")
            .withColumn(name, F.col("_place") + F.col("_add")).drop("_place", "_range", "_add"))


def dense_rank(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """``df`` with dense_rank() over (order by ``order``), nulls first and equal
    to each other.  The distinct keys are ranked and joined back; a key with very many rows is split by the
    engine's skew join.  ``df`` is read twice."""
    keys = stage(df.select(*order).distinct(), "rank-keys")
    ranked = positions(keys, order, name).select(*[F.col(c).alias(f"_k_{c}") for c in order], name)
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in order]
    return df.join(ranked, same).select(*df.columns, name)

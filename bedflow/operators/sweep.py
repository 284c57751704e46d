"""Census by sweep (J10, M9): how many stays lie over each day.

A stay adds one on its first day and takes one back on the day after its
last; the census is the running sum.  Stays are first counted by (first day,
length), combined map-side, so events number days x lengths, not stays, and no
stay is ever spread over its days.  The running sum has two levels: blocks of
days are summed, the sums are run up over the blocks, and the days of each
block are run up from there.  A task holds one block of a key, or the block sums of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Days of a block.
BLOCK_DAYS = 64
ORIGIN = "DATE'1970-01-01'"


def events(stays: DataFrame, keys: Sequence[str], first: str = "admit_date", length: str = "beddeddays") -> DataFrame:
    """(keys..., day, change): net change of the census on each day with one.
    Stays without a first day or of no length take no part."""
    counted = (stays.where(F.col(first).isNotNull() & (F.col(length) > 0))
               .groupBy(*keys, F.col(first).alias("_first"), F.col(length).alias("_length"))
               .agg(F.count(F.lit(1)).alias("_n")))
    begins = counted.select(*keys, F.col("_first").alias("day"), F.col("_n").alias("change"))
    ends = counted.select(*keys, F.expr("date_add(_first, CAST(_length AS INT))").alias("day"), (-F.col("_n")).alias("change"))
    return begins.unionByName(ends).groupBy(*keys, "day").agg(F.sum("change").alias("change"))


def census(stays: DataFrame, keys: Sequence[str], first: str = "admit_date", length: str = "beddeddays",
           block_days: int = BLOCK_DAYS) -> DataFrame:
    """(keys..., day, census) for every day from a key's first admission to
    its last day in bed, days without anyone included.  NULL keys are a key."""
    keys = list(keys)
    block = F.floor(F.datediff("day", F.expr(ORIGIN)) / block_days).cast("int")
    net = events(stays, keys, first, length).withColumn("_block", block)
    # one row a key: its blocks, and the days inside them, come from these bounds
    bounds = net.groupBy(*keys).agg(F.min("day").alias("_from"), F.max("day").alias("_to"),
                                    F.min("_block").alias("_b0"), F.max("_block").alias("_b1"))
    blocks = bounds.select(*keys, "_from", "_to", F.explode(F.sequence("_b0", "_b1")).alias("_block"))
    sums = net.groupBy(*keys, "_block").agg(F.sum("change").alias("_sum"))

    def same(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
        renamed = right.select(*[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on])
        out = left.join(renamed, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on], "left")
        return out.drop(*[f"_r_{c}" for c in on])

    over = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    opening = same(blocks, sums, [*keys, "_block"]).withColumn("_open", F.coalesce(F.sum("_sum").over(
        over.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    start = f"date_add({ORIGIN}, _block * {block_days})"
    # the day after the last one may be the first of its block: that block has no days
    opening = opening.where(F.expr(f"date_sub(_to, 1) >= {start}"))
    days = opening.select(*keys, "_block", "_open", F.explode(F.expr(
        f"sequence(greatest(_from, {start}), least(date_sub(_to, 1), date_add({start}, {block_days - 1})))"
    )).alias("day"))
    within = Window.partitionBy(*keys, "_block").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return same(days, net.drop("_block"), [*keys, "day"]).select(
        *keys, "day", (F.col("_open") + F.coalesce(F.sum("change").over(within), F.lit(0))).alias("census"))

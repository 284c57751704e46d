"""Column estimates kept as mergeable sketches (M10).

Each day's rows become one small row per column: counts, a HyperLogLog sketch
of the distinct values and a KLL sketch of the quantiles, both as binary.  The
rows are published by month (``sources.published``); any range of days is answered
by merging its sketches, so the rows behind them are read once, on their day.

Errors: the HyperLogLog sketch has 2**``LG_K`` registers, a relative standard
error of 1.04 / sqrt(2**LG_K) (0.0163 at 12) whatever was merged; the KLL sketch of
``KLL_K`` misses a rank by under 2.3 / KLL_K**0.9 of the rows (0.0056 at 800) in
99 % of the cases.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bedflow.operators.state import months_between
from bedflow.sources import published

LG_K = 12
KLL_K = 800
QUANTILES = (0.25, 0.5, 0.75)

DAILY = T.StructType([
    T.StructField("day", T.DateType()), T.StructField("column_name", T.StringType()),
    T.StructField("n_rows", T.LongType()), T.StructField("n_nulls", T.LongType()),
    T.StructField("distinct_sketch", T.BinaryType()), T.StructField("quantile_sketch", T.BinaryType())])


def daily_sketches(df: DataFrame, day: str, columns: Sequence[str], numeric: Sequence[str] = ()) -> DataFrame:
    """Per day and column: n_rows, n_nulls, the sketch of the distinct values,
    and for ``numeric`` columns that of the quantiles (else NULL).  Rows without
    a day are left out.  One pass: every column is an aggregate of the same
    grouping by day, so the shuffle carries sketches, never rows, and a day with
    a third of all rows costs no task more than its partial sketches."""
    names, aggs = [*dict.fromkeys([*columns, *numeric])], [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(names):
        aggs += [F.count(F.col(c)).alias(f"_c{i}"),
                 F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(f"_h{i}")]
        if c in numeric:
            aggs.append(F.kll_sketch_agg_double(F.col(c).cast("double"), KLL_K).alias(f"_q{i}"))
    by_day = df.where(F.col(day).isNotNull()).groupBy(F.col(day).cast("date").alias("day")).agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("n_rows"),
                     (F.col("_n") - F.col(f"_c{i}")).alias("n_nulls"), F.col(f"_h{i}").alias("distinct_sketch"),
                     (F.col(f"_q{i}") if c in numeric else F.lit(None).cast("binary")).alias("quantile_sketch"))
            for i, c in enumerate(names)]
    return by_day.select("day", F.explode(F.array(*rows)).alias("x")).select("day", "x.*")


def keep_days(spark: SparkSession, root: str, daily: DataFrame) -> published.Manifest:
    """Publishes the days of ``daily``; a day that is in already is replaced,
    so a repeated or corrected delivery counts once.  Only the months of these days
    are read and written."""
    month = F.date_format("day", "yyyy-MM")
    new = daily.select(*[F.col(f.name).cast(f.dataType) for f in DAILY]).withColumn("part", month)

    def change(base: published.Manifest):
        touched = [r[0] for r in new.select("part").distinct().collect()]  # months
        if not touched:
            return None
        old = published.rows_of(spark, root, base, touched).withColumn("part", month)
        kept = old.join(new.select("day").distinct(), "day", "left_anti")
        return published.write_aside(kept.unionByName(new).repartition("part"), root, "part"), {"lg_k": LG_K}
    return published.update(spark, root, DAILY, change)


def stored_days(spark: SparkSession, root: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The daily rows from ``first`` to ``last``; only the files of these months are opened."""
    found = published.manifest(spark, root)
    if found is None:
        return spark.createDataFrame([], DAILY)
    low, high = (f"{d:%Y-%m}" if d else None for d in (first, last))
    parts = [p for p in found.parts if (low is None or p >= low) and (high is None or p <= high)]
    days = published.rows_of(spark, root, found, parts)
    day = F.col("day")
    return days.where((day >= F.lit(first) if first else F.lit(True)) & (day <= F.lit(last) if last else F.lit(True)))


def merged(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per column (and ``by``): n_rows, n_nulls, the sketches merged.  Merging
    is associative and combines map-side, so months may be merged to years."""
    return daily.groupBy(*by, "column_name").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        # a sketch per column: those without one are no input
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"))


def estimates(sketches: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """``approx_distinct`` and one column p25, p50, ... per quantile (NULL for
    columns without numbers), beside the exact counts."""
    held = F.col("quantile_sketch").isNotNull() & (F.kll_sketch_get_n_double("quantile_sketch") > 0)
    keys = [c for c in sketches.columns if c not in ("distinct_sketch", "quantile_sketch")]
    return sketches.select(
        *keys, F.hll_sketch_estimate("distinct_sketch").alias("approx_distinct"),
        *[F.when(held, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(q)))).alias(f"p{round(q * 100)}")
          for q in quantiles])


def distinct_error(k: float = 4.0) -> float:
    """``k`` standard errors of the distinct counts."""
    return k * 1.04 / 2 ** (LG_K / 2)


def rank_error(k: float = 2.0) -> float:
    """The share of rows by which a quantile's rank may be off: ``k`` times the 99 % bound."""
    return k * 2.3 / KLL_K ** 0.9

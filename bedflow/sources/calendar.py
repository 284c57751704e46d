"""Date dimension and holiday calendar as generated DataFrames.

The calendar is a few thousand rows whatever the data volume, so it is
generated with ``range`` rather than stored, and is safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedflow.config import Params
from bedflow.functions.dates import lit_date

# Holiday month/day pairs of the fixture's holiday dimension.
HOLIDAY_MONTH_DAYS = ((1, 1), (7, 4), (12, 25))


def date_dim(spark: SparkSession, p: Params) -> DataFrame:
    """(day_key, day, day_of_week); day_key 1 is ``p.calendar_start``."""
    return (
        spark.range(p.calendar_first_key, p.calendar_days + 1, numPartitions=1)
        .select(F.col("id").cast("int").alias("day_key"))
        .withColumn("day", F.date_add(lit_date(p.calendar_start), F.col("day_key") - 1))
        .withColumn("day_of_week", F.date_format("day", "EEEE"))
    )


def holiday_dim(spark: SparkSession, p: Params) -> DataFrame:
    """(date) for every fixed holiday inside the calendar."""
    first, last = p.calendar_first_day, p.calendar_end
    days = F.array(*[F.make_date(F.col("year"), F.lit(m), F.lit(d))
                     for m, d in HOLIDAY_MONTH_DAYS])
    return (
        spark.range(first.year, last.year + 1, numPartitions=1)
        .select(F.col("id").cast("int").alias("year"))
        .select(F.explode(days).alias("date"))
        .where(F.col("date").between(lit_date(first), lit_date(last)))
    )

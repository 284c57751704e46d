"""Tables kept up to date from a day's changes instead of from all history.

Two states, published part by part (``sources.published``):

* the length-of-stay histogram (A1, A3): additive counts, changed by rows that
  carry +1 or -1.  A stay that turns from Current to Past adds one; a corrected
  length of stay takes one back and adds another; a deleted stay takes one back.
* the first snapshot of each emergency stay (A8, A9): a minimum, which a day's
  snapshots can only lower.

A change reads its own rows and the parts it touches, writes those parts anew
and commits one manifest: a killed run leaves the state as it was, a repeated
batch changes nothing, and of two writers at the same time one starts over on the
other's version.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bedflow.config import (ED_ADMIT_CATEGORY, ED_RECLASS_LOOKBACK_MONTHS, ED_RECLASS_MAX_DAYS, ED_STAY_DATE_OFFSET,
                            SNAPSHOT_MODEL_NAME, Params)
from bedflow.functions.dates import lit_date, months_after
from bedflow.operators.survival import past_stays
from bedflow.sources import published

#: Parts of the histogram.  It has (services x LOS values) rows; a change rewrites the parts of its services.
HISTOGRAM_BUCKETS = 16
#: Parts of the first snapshots inside one month of admission.
FIRST_SEEN_BUCKETS = 4

HISTOGRAM = T.StructType([T.StructField("service_code", T.StringType()), T.StructField("beddeddays", T.IntegerType()),
                          T.StructField("patients", T.LongType())])
FIRST_SEEN = T.StructType([T.StructField("stay_key", T.StringType()), T.StructField("admit_date", T.DateType()),
                           T.StructField("first_seen", T.DateType())])


def bucket(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets))


def _touched(rows: DataFrame) -> list[str]:
    """The parts that ``rows`` (part, ...) belong to; bounded by the number of parts."""
    return [r[0] for r in rows.select("part").distinct().collect()]


# --- length-of-stay histogram ----------------------------------------------------

def row_changes(before: DataFrame, after: DataFrame, key: str = "contact_serial_number") -> DataFrame:
    """The changed rows of a day as +1 and -1: ``before`` holds the changed
    rows as they were known, ``after`` as they are now; a row in only one of
    them was added or deleted.  Rows equal in both cancel."""
    columns = after.columns
    signed = (before.select(*columns).withColumn("change", F.lit(-1))
              .unionByName(after.withColumn("change", F.lit(1))))
    return (signed.groupBy(*columns).agg(F.sum("change").cast("int").alias("change"))
            .where((F.col("change") != 0) & F.col(key).isNotNull()))


def histogram_delta(changes: DataFrame) -> DataFrame:
    """(service_code, beddeddays, patients) to add: the net change of past
    stays per length of stay, combined map-side.  ``changes`` has the encounter
    columns patient_type, beddeddays, service_code, and change (+1 or -1)."""
    return (past_stays(changes).groupBy("service_code", "beddeddays")
            .agg(F.sum("change").cast("long").alias("patients")).where("patients <> 0"))


def apply_histogram(spark: SparkSession, root: str, delta: DataFrame, batch: str,
                    buckets: int = HISTOGRAM_BUCKETS) -> published.Manifest:
    """Adds ``delta`` to the histogram under ``root`` as batch ``batch``.

    Only the parts of the services in ``delta`` are read and written.  Entries
    that come to zero vanish.  A batch that is in already changes nothing.  An
    entry below zero (a stay taken back that was never added) raises, and the state stays
    as it was.
    """
    delta = delta.select(*[F.col(f.name).cast(f.dataType) for f in HISTOGRAM]).withColumn(
        "part", bucket("service_code", buckets).cast("string"))

    def change(base: published.Manifest):
        done = base.about.get("batches", [])
        if batch in done:
            return None
        if base.about.get("buckets", buckets) != buckets:
            raise ValueError(f"{root} has {base.about['buckets']} buckets, not {buckets}")
        touched = _touched(delta)
        about = {"batches": [*done, batch], "buckets": buckets}
        if not touched:
            return {}, about
        old = published.rows_of(spark, root, base, touched).withColumn(
            "part", bucket("service_code", buckets).cast("string"))
        merged = (old.unionByName(delta).groupBy("part", "service_code", "beddeddays")
                  .agg(F.sum("patients").alias("patients")).where("patients <> 0"))
        # one file a part: a part holds few services
        parts = published.write_aside(merged.repartition(len(touched), "part"), root, "part")
        wrong = spark.read.schema(HISTOGRAM).parquet(*[f"{root.rstrip('/')}/{f}" for f in parts.values()]).where(
            "patients < 0").limit(1).collect() if parts else []
        if wrong:
            raise ValueError(f"batch {batch} takes back stays that were never added: {wrong[0].asDict()}")
        return {p: parts.get(p) for p in touched}, about
    return published.update(spark, root, HISTOGRAM, change)


def histogram(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The state as a ``stay_histogram``: the LOS feature and the curves of all
    models derive from it."""
    return published.read(spark, root, version)


# --- first snapshot of emergency stays ---------------------------------------------

def ed_snapshots(snapshots: DataFrame) -> DataFrame:
    """The snapshot rows that tell when an emergency stay was seen."""
    return snapshots.where((F.col("orig_model_name") == SNAPSHOT_MODEL_NAME)
                           & (F.col("category_desc") == ED_ADMIT_CATEGORY)
                           & (F.col("stay_date_offset") == ED_STAY_DATE_OFFSET)
                           & F.col("snapshot_date").isNotNull() & F.col("admit_date").isNotNull())


def month_part(day: Column, buckets: int) -> Column:
    return F.concat(F.date_format(day, "yyyy-MM"), F.lit("-"), bucket("stay_key", buckets).cast("string"))


def merge_snapshots(spark: SparkSession, root: str, day: DataFrame,
                    buckets: int = FIRST_SEEN_BUCKETS) -> published.Manifest:
    """Merges the snapshots of a day (or of any days) into the first snapshot
    per stay.  The table is divided by month of admission, so the day's stays
    touch the months they were admitted in; older months are neither read nor
    written.  Merging the same snapshots again changes nothing."""
    lowest = (ed_snapshots(day).groupBy("stay_key", "admit_date")
              .agg(F.min("snapshot_date").alias("first_seen")).withColumn("part", month_part(F.col("admit_date"), buckets)))

    def change(base: published.Manifest):
        touched = _touched(lowest)
        if not touched:
            return None
        old = published.rows_of(spark, root, base, touched).withColumn(
            "part", month_part(F.col("admit_date"), buckets))
        merged = (old.unionByName(lowest).groupBy("part", "stay_key", "admit_date")
                  .agg(F.min("first_seen").alias("first_seen")))
        return published.write_aside(merged.repartition("part"), root, "part"), {"buckets": buckets}
    return published.update(spark, root, FIRST_SEEN, change)


def months_between(first: dt.date, last: dt.date) -> list[str]:
    out, year, month = [], first.year, first.month
    while (year, month) <= (last.year, last.month):
        out.append(f"{year:04d}-{month:02d}")
        year, month = (year + 1, 1) if month == 12 else (year, month + 1)
    return out


def first_seen(spark: SparkSession, root: str, months: Sequence[str] | None = None) -> DataFrame:
    """(stay_key, admit_date, first_seen), of stays admitted in ``months`` only
    if given (their files alone are opened)."""
    found = published.manifest(spark, root)
    if found is None:
        return spark.createDataFrame([], FIRST_SEEN)
    wanted = None if months is None else [p for p in found.parts if p[:7] in set(months)]
    return published.rows_of(spark, root, found, wanted)


def reclassification_rate(spark: SparkSession, root: str, p: Params) -> DataFrame:
    """One row, ed_reclassification_rate, from the state; the days before
    ``p.as_of`` must have been merged.  Later ones do no harm: they lower no
    minimum that lies before it.  Reads the months that the look-back covers."""
    year, month = p.as_of.year, p.as_of.month - ED_RECLASS_LOOKBACK_MONTHS
    start = dt.date(year + (month - 1) // 12, (month - 1) % 12 + 1, 1)
    as_of, seen, admitted = lit_date(p.as_of), F.col("first_seen"), F.col("admit_date")
    recent = first_seen(spark, root, months_between(start, p.as_of)).where(
        (admitted < F.date_sub(as_of, 1)) & (seen < as_of) & (seen > lit_date(p.snapshots_from))
        & (F.datediff(seen, admitted) <= ED_RECLASS_MAX_DAYS)
        & (admitted >= months_after(p.as_of, -ED_RECLASS_LOOKBACK_MONTHS)))
    late = (F.datediff(seen, admitted) != 1).cast("int")
    return recent.agg(F.try_divide(F.sum(late), F.count(F.lit(1))).cast("double").alias("ed_reclassification_rate"))

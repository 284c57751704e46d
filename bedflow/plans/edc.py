"""ED(C): stay rates for current emergency patients, pooled over services
and weighted by the ED reclassification rate.

Differences from CP(C) that must be kept:

* one global curve (no cohort);
* the original scaffold spans the whole calendar, so a patient also gets
  rows *past* the observed max LOS (and rows for every day when f itself is
  past the max), all with a NULL rate, up to the horizon (N2).  We emit them
  per patient with a ``sequence`` that ends at the horizon, without a calendar;
* ``num_of_patient`` is the reclassification rate (a one-row result,
  attached as a scalar subquery; no cross join).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedflow.config import (CURRENT, ED_ADMIT_CATEGORY, ED_RECLASS_LOOKBACK_MONTHS,
                            ED_RECLASS_MAX_DAYS, ED_STAY_DATE_OFFSET, EDC_MODEL_NAME,
                            EMERGENCY_CARE_CLASS, SNAPSHOT_MODEL_NAME, Params)
from bedflow.functions.dates import lit_date, months_after
from bedflow.operators import stays as S
from bedflow.operators.survival import conditional_rates, curve_arrays, stay_histogram
from bedflow.plans.common import common_format


def ed_reclassifications(snapshots: DataFrame, p: Params) -> DataFrame:
    """Per ED-admitted stay: first snapshot date and the reclassified flag."""
    as_of = lit_date(p.as_of)
    first = (snapshots
             .where((F.col("orig_model_name") == SNAPSHOT_MODEL_NAME)
                    & (F.col("category_desc") == ED_ADMIT_CATEGORY)
                    & (F.col("stay_date_offset") == ED_STAY_DATE_OFFSET)
                    & (F.col("admit_date") < F.date_sub(as_of, 1))
                    & (F.col("snapshot_date") < as_of))
             .groupBy("stay_key", "admit_date")
             .agg(F.min("snapshot_date").alias("min_snapshot_date"))
             .where(F.col("min_snapshot_date") > lit_date(p.snapshots_from)))
    return first.withColumn(
        "ed_reclassification_i",
        F.when(F.col("admit_date") == F.date_sub("min_snapshot_date", 1), F.lit(0)).otherwise(F.lit(1)))


def ed_reclassification_rate(snapshots: DataFrame, p: Params) -> DataFrame:
    """One row: share of recent ED admissions that were reclassified."""
    recent = ed_reclassifications(snapshots, p).where(
        (F.datediff("min_snapshot_date", "admit_date") <= ED_RECLASS_MAX_DAYS)
        & (F.col("admit_date") >= months_after(p.as_of, -ED_RECLASS_LOOKBACK_MONTHS)))
    return recent.agg(F.try_divide(F.sum("ed_reclassification_i"), F.count(F.lit(1)))
                      .cast("double").alias("ed_reclassification_rate"))


def edc_curve(hist: DataFrame) -> DataFrame:
    """Exactly one row: the pooled curve array ``s`` and ``max_los`` of a
    ``stay_histogram``."""
    pooled = hist.groupBy("beddeddays").agg(F.sum("patients").alias("patients"))
    return curve_arrays(pooled, [])


def edc_rates_pooled(encounters: DataFrame) -> DataFrame:
    """(days_stayed, stay_day, stay_rate) of the pooled curve."""
    return conditional_rates(edc_curve(stay_histogram(encounters)), [])


def current_emergencies(encounters: DataFrame) -> DataFrame:
    return encounters.where((F.col("patient_type") == CURRENT)
                            & (F.col("beddeddays") > 0)
                            & (F.col("care_class") == EMERGENCY_CARE_CLASS))


def _patients(encounters: DataFrame, hist: DataFrame, rate: DataFrame, computed: bool) -> DataFrame:
    curve = edc_curve(hist).select(F.struct("s", "max_los")).scalar()
    current = current_emergencies(encounters)
    if not computed:
        # an empty rate table yields no rows at all (as a cross join with it would)
        current = current.where(rate.exists())
    rows = current.select(
        F.col("contact_serial_number").alias("stay_key"), "admit_date", "beddeddays",
        F.col("patient_type").alias("patient_timeframe"), curve.alias("_curve"),
        rate.select("ed_reclassification_rate").scalar().alias("num_of_patient"))
    return rows.withColumn("s", F.col("_curve.s")).withColumn("max_los", F.col("_curve.max_los"))


def _last_day(p: Params) -> Column:
    """The last stay day: the horizon, or the longest past stay before it.
    Without history no patient has a day inside the observed range."""
    horizon = S.horizon_last_day(p, F.col("admit_date"))
    if p.keep_unrated_tail:
        return horizon
    return F.least(F.coalesce("max_los", F.lit(0)), horizon)


def _keep() -> list[str]:
    return ["stay_key", "patient_timeframe", "num_of_patient"]


def _rows(encounters: DataFrame, rate: DataFrame, p: Params, future: bool, backfill: bool,
          hist: DataFrame | None = None, computed: bool = False) -> DataFrame:
    patients = _patients(encounters, stay_histogram(encounters) if hist is None else hist, rate, computed)
    rows = S.stay_days(patients, _last_day(p), p, _keep(), future, backfill)
    return common_format(rows, p, EDC_MODEL_NAME, F.col("num_of_patient"))


def edc_future(encounters: DataFrame, rate: DataFrame, p: Params) -> DataFrame:
    return _rows(encounters, rate, p, future=True, backfill=False)


def edc_backfill(encounters: DataFrame, rate: DataFrame, p: Params) -> DataFrame:
    return _rows(encounters, rate, p, future=False, backfill=True)


def edc_model(encounters: DataFrame, p: Params, rate: DataFrame | None = None,
              snapshots: DataFrame | None = None, hist: DataFrame | None = None) -> DataFrame:
    """Backfill and future rows.  ``rate`` overrides the freshly computed
    reclassification rate (N4); otherwise ``snapshots`` is needed.  ``hist``
    is a staged ``stay_histogram``, where several models share it."""
    computed = rate is None
    if computed:
        if snapshots is None:
            raise ValueError("edc_model needs the snapshot table or a rate")
        rate = ed_reclassification_rate(snapshots, p)  # always one row
    return _rows(encounters, rate, p, True, True, hist, computed)

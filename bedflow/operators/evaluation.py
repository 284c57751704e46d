"""Rolling-origin evaluation of the stay models (M9): forecasts made as of
many dates, in one plan, against what became of the stays.

``as_of`` is a column here, not a constant.  Every stay, known to its end, is
seen as each origin saw it: past if it ended before, current if it was
in bed the night before, unknown if it came later.  Neither the forecasts nor
the outcomes are built per patient and day:

* the history of all origins is one histogram by (first origin after the end,
  cohort, length), run up over the origins;
* the patients of an origin are counted by (cohort, days stayed, final length);
* both give, per cohort and days stayed, a curve array; a forecast day is a
  look-up in the one, an outcome a look-up in the other.

So after one scan everything is bounded by origins x cohorts x days, whatever the
number of stays.  Stays need stay_key, service_code, care_class, admit_date and
beddeddays (the final length); rows without a date, service or length take no
part.  Patients whose days stayed have no survivors in their cohort's history get no
forecast and are left out; a day beyond the history's longest stay has the rate 0.

The definitions are ours: upstream names the metrics in prose only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedflow.config import (CPC_MODEL_NAME, ED_RECLASS_LOOKBACK_MONTHS, ED_RECLASS_MAX_DAYS, EDC_MODEL_NAME,
                            EMERGENCY_CARE_CLASS, Params)
from bedflow.functions.dates import lit_date
from bedflow.operators.state import ed_snapshots
from bedflow.operators.survival import curve_arrays

#: Cohort of the pooled model; no service code holds a line break.
POOLED = "all\n"
BINS = 10
#: horizon_day of the row over all days.
ALL_DAYS = -1


def origin_array(origins: Sequence[dt.date]) -> Column:
    return F.array(*[lit_date(o) for o in sorted(set(origins))])


def _ended(stays: DataFrame) -> DataFrame:
    known = stays.where(F.col("admit_date").isNotNull() & F.col("service_code").isNotNull() & (F.col("beddeddays") > 0))
    return known.select("service_code", "care_class", "admit_date", F.col("beddeddays").cast("int").alias("los"),
                        F.expr("date_add(admit_date, CAST(beddeddays AS INT))").alias("end"))


def origin_histograms(stays: DataFrame, origins: Sequence[dt.date]) -> DataFrame:
    """(as_of, service_code, beddeddays, patients): the stays that had ended
    before each origin."""
    dates, last = origin_array(origins), len(set(origins))
    first = F.size(F.filter(dates, lambda o: o <= F.col("end")))  # origins that do not know the end yet
    counted = (_ended(stays).withColumn("_first", first).where(F.col("_first") < last)
               .groupBy("_first", "service_code", "los").agg(F.count(F.lit(1)).alias("n")))
    # services x lengths x origins rows
    each = counted.select("service_code", "los", "n", F.explode(F.sequence("_first", F.lit(last - 1))).alias("_at"))
    return (each.groupBy(F.element_at(dates, F.col("_at") + 1).alias("as_of"), "service_code", F.col("los").alias("beddeddays"))
            .agg(F.sum("n").alias("patients")))


def origin_patients(stays: DataFrame, origins: Sequence[dt.date]) -> DataFrame:
    """(as_of, model_name, service_code, days_stayed, beddeddays, patients):
    the patients in bed the night before each origin, by final length."""
    dates = origin_array(origins)
    seen = F.filter(dates, lambda o: (o > F.col("admit_date")) & (o <= F.col("end")))
    model = F.when(F.col("care_class") == EMERGENCY_CARE_CLASS, EDC_MODEL_NAME).when(
        F.col("care_class").isNotNull(), CPC_MODEL_NAME)
    rows = (_ended(stays).withColumn("model_name", model).where(F.col("model_name").isNotNull())
            .withColumn("_seen", seen).where(F.size("_seen") > 0))
    each = rows.select("model_name", "service_code", "admit_date", "los", F.explode("_seen").alias("as_of"))
    return (each.groupBy("as_of", "model_name", "service_code", F.datediff("as_of", "admit_date").alias("days_stayed"),
                         F.col("los").alias("beddeddays"))
            .agg(F.count(F.lit(1)).alias("patients")))


def forecast_cells(stays: DataFrame, origins: Sequence[dt.date], horizon: int) -> DataFrame:
    """(as_of, model_name, cohort, days_stayed, horizon_day, patients, stay_rate,
    stayed): per origin, cohort and days stayed, the rate the model gives its
    patients for the day ``horizon_day`` after the origin (0: the origin
    itself), and how many of them were still in bed on it."""
    hist = origin_histograms(stays, origins)
    cohort = F.col("service_code").alias("cohort")
    by_service = curve_arrays(hist.select("as_of", cohort, "beddeddays", "patients"), ["as_of", "cohort"])
    pooled = hist.groupBy("as_of", "beddeddays").agg(F.sum("patients").alias("patients"))
    over_all = curve_arrays(pooled.withColumn("cohort", F.lit(POOLED)), ["as_of", "cohort"])
    curves = (by_service.withColumn("model_name", F.lit(CPC_MODEL_NAME))
              .unionByName(over_all.withColumn("model_name", F.lit(EDC_MODEL_NAME)))
              .select("as_of", "model_name", "cohort", "s"))
    patients = origin_patients(stays, origins).withColumn(
        "cohort", F.when(F.col("model_name") == EDC_MODEL_NAME, POOLED).otherwise(F.col("service_code")))
    groups = ["as_of", "model_name", "cohort", "days_stayed"]
    outcome = curve_arrays(patients.groupBy(*groups, "beddeddays").agg(F.sum("patients").alias("patients")), groups)
    joined = (outcome.select(*groups, F.col("s").alias("_out"), F.col("total").alias("patients"))
              .join(curves, ["as_of", "model_name", "cohort"])
              .withColumn("_now", F.try_element_at("s", F.col("days_stayed"))).where(F.col("_now") > 0))
    day = F.col("days_stayed") + 1 + F.col("horizon_day")
    days = joined.select("*", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("horizon_day"))
    return days.select(
        *groups, "horizon_day", "patients",
        (F.coalesce(F.try_element_at("s", day), F.lit(0)) / F.col("_now")).alias("stay_rate"),
        F.coalesce(F.try_element_at("_out", day), F.lit(0)).cast("long").alias("stayed"))


def origin_reclassification(snapshots: DataFrame, origins: Sequence[dt.date], p: Params) -> DataFrame:
    """(as_of, ed_reclassification_rate) of every origin, from one minimum per
    stay: snapshots after an origin cannot lower a minimum before it."""
    first = ed_snapshots(snapshots).groupBy("stay_key", "admit_date").agg(F.min("snapshot_date").alias("seen"))
    recent = F.filter(origin_array(origins), lambda o: (
        (F.col("admit_date") < F.date_sub(o, 1)) & (F.col("seen") < o)
        & (F.col("admit_date") >= F.add_months(o, -ED_RECLASS_LOOKBACK_MONTHS))))
    late = F.datediff("seen", "admit_date")
    return (first.where((F.col("seen") > lit_date(p.snapshots_from)) & (late <= ED_RECLASS_MAX_DAYS))
            .select(F.explode(recent).alias("as_of"), (late != 1).cast("int").alias("_late")).groupBy("as_of")
            .agg((F.sum("_late") / F.count(F.lit(1))).alias("ed_reclassification_rate")))


def forecast_errors(cells: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """(model_name, as_of, horizon_day, patients, predicted, realised, error):
    bed-days forecast and realised per origin and day.  ``weights`` (as_of,
    ed_reclassification_rate) scales the ED(C) forecast, as the model does; an
    origin without one has the weight null and no forecast."""
    bed_days = F.col("patients") * F.col("stay_rate")
    if weights is not None:
        cells = cells.join(F.broadcast(weights), "as_of", "left")  # one row an origin
        bed_days = F.when(F.col("model_name") == EDC_MODEL_NAME, bed_days * F.col("ed_reclassification_rate")).otherwise(bed_days)
    return (cells.groupBy("model_name", "as_of", "horizon_day")
            .agg(F.sum("patients").alias("patients"), F.sum(bed_days).alias("predicted"),
                 F.sum("stayed").alias("realised"))
            .withColumn("error", F.col("predicted") - F.col("realised")))


def accuracy(errors: DataFrame) -> DataFrame:
    """(model_name, horizon_day, n, bias, mae, rmse) over the origins, per
    day of the horizon, and over all its days as horizon_day ``ALL_DAYS``."""
    e = F.col("error")
    return (errors.where(e.isNotNull()).rollup("model_name", "horizon_day")
            .agg(F.count(F.lit(1)).alias("n"), (F.round(F.avg(e), 6) + 0.0).alias("bias"),
                 (F.round(F.avg(F.abs(e)), 6) + 0.0).alias("mae"), (F.round(F.sqrt(F.avg(e * e)), 6) + 0.0).alias("rmse"))
            .where(F.col("model_name").isNotNull())
            .withColumn("horizon_day", F.coalesce("horizon_day", F.lit(ALL_DAYS))))


def calibration(cells: DataFrame, bins: int = BINS) -> DataFrame:
    """(model_name, bin, n, mean_rate, observed, gap): reliability of the stay
    rates in ``bins`` equal widths, numbered from 1 (a rate of 1 is in the last)."""
    b = F.least(F.floor(F.col("stay_rate") * bins), F.lit(bins - 1)).cast("int") + 1
    n = F.sum("patients")
    sums = cells.groupBy("model_name", b.alias("bin")).agg(
        n.alias("n"), F.sum(F.col("patients") * F.col("stay_rate")).alias("_p"), F.sum("stayed").alias("_y"))
    return sums.select("model_name", "bin", "n", (F.round(F.col("_p") / F.col("n"), 9) + 0.0).alias("mean_rate"),
                       (F.round(F.col("_y") / F.col("n"), 9) + 0.0).alias("observed"),
                       (F.round((F.col("_p") - F.col("_y")) / F.col("n"), 9) + 0.0).alias("gap"))


def brier(cells: DataFrame, bins: int = BINS) -> DataFrame:
    """(model_name, n, brier, reliability, resolution, uncertainty, within_bins):
    the mean squared distance of a rate from its outcome (0 or 1), and its
    parts: brier = reliability - resolution + uncertainty + within_bins."""
    b = F.least(F.floor(F.col("stay_rate") * bins), F.lit(bins - 1))
    n, p, y = F.col("patients"), F.col("stay_rate"), F.col("stayed")
    per_bin = cells.groupBy("model_name", b.alias("bin")).agg(
        F.sum(n).alias("_n"), F.sum(n * p).alias("_p"), F.sum(y).alias("_y"),
        F.sum(n * p * p - 2 * p * y + y).alias("_b"))
    one = per_bin.groupBy("model_name").agg(
        F.sum("_n").alias("n"), F.sum("_b").alias("_b"), F.sum("_y").alias("_y"),
        F.sum(F.pow(F.col("_p") - F.col("_y"), F.lit(2)) / F.col("_n")).alias("_rel"),
        F.sum(F.pow(F.col("_y"), F.lit(2)) / F.col("_n")).alias("_y2"))
    total = F.col("n").cast("double")
    rate = F.col("_y") / total
    parts = {"brier": F.col("_b") / total, "reliability": F.col("_rel") / total,
             "resolution": F.col("_y2") / total - rate * rate, "uncertainty": rate * (1 - rate)}
    parts["within_bins"] = parts["brier"] - parts["reliability"] + parts["resolution"] - parts["uncertainty"]
    return one.select("model_name", "n", *[(F.round(v, 9) + 0.0).alias(k) for k, v in parts.items()])

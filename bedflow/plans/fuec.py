"""FUEC: forecast of future urgent/emergency arrivals and their bed-days.

Per service key x month x weekday code (9 on holidays), the mean daily
number of urgent arrivals over the last two years is spread over the next
three months, then expanded into stay days with the cohort's survival rate
and expected LOS.

Rewrites of the original shape (results are equal, row for row):

* Seasonal mean (J6/J7/A7).  The original averages over a zero-filled grid
  = calendar x service keys, left-joined to the daily arrivals.  The mean is
  sum/count over that grid, so we compute both parts without building it:
  sum = the arrivals; count = calendar days with that (month, code) plus the
  extra rows produced when several raw locations fold to one key on a day.
  Duplicate service-key rows (N5) multiply sum and count alike and cancel.
  Only positive means are kept: the forecast drops the rest (N8).
* Global dense_rank (W6).  A day's keys are those of its (month, weekday
  code) combo, so the rank = the place within the combo (global positions of
  the seasonal-mean rows, range-partitioned: no window over them) + the keys
  on earlier days (a cumulative sum over <= horizon-days rows).
* row_number over the LOS day (W5) is the scaffold day itself; the windowed
  sum of rates (W7) is the cohort's mean LOS, taken from the curve.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedflow.config import (FOLDED_LOCATION, FUEC_ADMIT_TYPES, FUEC_CARE_CLASSES,
                            HOLIDAY_DOW_CODE, HOLIDAY_FLAG, Params)
from bedflow.functions.dates import dow_code, lit_date, lit_ts_ntz, months_after
from bedflow.operators.ranking import positions
from bedflow.operators.survival import curve_arrays, past_stays, survival_curve
from bedflow.sources.sinks import stage

FEATURES = ["service_name", "month", "dayofweek", "admit_type", "location",
            "service_code", "site_desc"]
KEYS = ["service_name", "admit_type", "location", "service_code", "site_desc"]


def fold_location(c: Column, p: Params) -> Column:
    return F.when(c == p.kept_location, c).otherwise(F.lit(FOLDED_LOCATION))


def urgent_past(encounters: DataFrame) -> DataFrame:
    return past_stays(encounters).where(F.col("admit_type").isin(*FUEC_ADMIT_TYPES)
                                        & F.col("care_class").isin(*FUEC_CARE_CLASSES))


# ---------------------------------------------------------------- curves ----
def urgent_counts(encounters: DataFrame) -> DataFrame:
    """Urgent past stays pre-aggregated by every attribute FUEC reads:
    (admit_date, month/weekday of admit_dttm, holiday flag, raw keys, LOS, n).

    Both the cohort curves and the daily arrivals are derived from this one
    aggregate, so the encounter scan and its shuffle happen once (the
    exchange is reused); its size is bounded by days x keys x LOS values.
    """
    required = F.lit(True)
    for c in ["admit_date", "service_name", "admit_type", "service_code", "site_desc"]:
        required = required & F.col(c).isNotNull()
    # NULL keys or dates could never join a grid day or a cohort downstream.
    return (urgent_past(encounters).where(required)
            .groupBy("admit_date",
                     F.month("admit_dttm").alias("dttm_month"),
                     F.dayofweek("admit_dttm").alias("dttm_dow"),
                     (F.col("observed_holiday_ind") == HOLIDAY_FLAG).alias("is_holiday"),
                     "service_name", "admit_type", "location", "service_code", "site_desc",
                     "beddeddays")
            .agg(F.count(F.lit(1)).alias("n")))


def fuec_histogram(encounters: DataFrame, p: Params) -> DataFrame:
    pre = urgent_counts(encounters)
    stays = pre.select(
        "service_name",
        F.col("dttm_month").alias("month"),
        F.when(F.col("is_holiday"), F.lit(HOLIDAY_DOW_CODE)).otherwise(F.col("dttm_dow")).alias("dayofweek"),
        "admit_type",
        fold_location(F.col("location"), p).alias("location"),
        "service_code", "site_desc", "beddeddays", "n")
    return stays.groupBy(*FEATURES, "beddeddays").agg(F.sum("n").alias("patients"))


def fuec_cohort_rates(encounters: DataFrame, p: Params) -> DataFrame:
    """(features..., beddeddays, patients, running_patients, total_patients, stay_rate)."""
    keep = F.lit(True)
    for c in FEATURES:
        keep = keep & F.col(c).isNotNull()
    curve = survival_curve(fuec_histogram(encounters, p).where(keep), FEATURES)
    return curve.select(*FEATURES, F.col("stay_day").alias("beddeddays"), "patients",
                        F.col("at_risk").alias("running_patients"),
                        F.col("total").alias("total_patients"),
                        (F.col("at_risk") / F.col("total")).alias("stay_rate"))


def fuec_curves(encounters: DataFrame, p: Params) -> DataFrame:
    return curve_arrays(fuec_histogram(encounters, p), FEATURES)


# ----------------------------------------------------------- arrivals -------
def fuec_service_keys(encounters: DataFrame, p: Params) -> DataFrame:
    """Service keys of past stays; grouped by the raw location unless
    ``fold_first`` (N5), so a folded key repeats once per raw location."""
    past = encounters.where(F.col("patient_type") == "Past")
    loc = fold_location(F.col("location"), p) if p.fold_first else F.col("location")
    g = past.select("service_name", "admit_type", loc.alias("location"),
                    "service_code", "site_desc").distinct()
    return g.select("service_name", "admit_type", fold_location(F.col("location"), p).alias("location"),
                    "service_code", "site_desc")


def fuec_daily_arrivals(encounters: DataFrame, p: Params) -> DataFrame:
    """(admit_date, keys..., patients): weighted urgent arrivals per day and
    key; admissions before ``uplift_before`` weigh ``uplift`` (exact decimal)."""
    weight = (F.when(F.col("admit_date") < lit_date(p.uplift_before), F.lit(Decimal(p.uplift)))
              .otherwise(F.lit(Decimal(1))))
    loc = fold_location(F.col("location"), p) if p.fold_first else F.col("location")
    g = (urgent_counts(encounters)
         .groupBy("admit_date", "service_name", "admit_type", loc.alias("location"),
                  "service_code", "site_desc")
         .agg(F.sum(weight * F.col("n")).alias("patients")))
    return g.select("admit_date", "service_name", "admit_type",
                    fold_location(F.col("location"), p).alias("location"),
                    "service_code", "site_desc", "patients")


def _coded_days(date_dim: DataFrame, holidays: DataFrame, lo: Column, hi: Column) -> DataFrame:
    """Calendar days in [lo, hi) with month and weekday code.  Both inputs
    are calendar-sized, so the result is bounded by the window length."""
    hol = (holidays.where((F.col("date") >= lo) & (F.col("date") < hi))
           .select(F.col("date").alias("_hol")).distinct())  # at most the window's days
    days = date_dim.where((F.col("day") >= lo) & (F.col("day") < hi))
    return (days.join(F.broadcast(hol), days.day == hol._hol, "left")
            .select("day", "day_of_week", F.month("day").alias("month"),
                    dow_code(F.col("day"), F.col("_hol").isNotNull()).alias("dayofweek")))


def require_calendar(date_dim: DataFrame, p: Params) -> None:
    """Raise if the calendar does not hold every day of the history and the
    horizon: FUEC would lose days without a trace."""
    lo, hi = months_after(p.as_of, -12 * p.history_years), months_after(p.as_of, p.horizon_months)
    inside = F.when((F.col("day") >= lo) & (F.col("day") < hi), F.col("day"))
    have, want = date_dim.agg(F.count_distinct(inside), F.first(F.datediff(hi, lo))).first()
    if not want or have < want:
        raise ValueError(f"the calendar holds {have} of the {want} days that FUEC needs around {p.as_of}")


def history_days(date_dim: DataFrame, holidays: DataFrame, p: Params) -> DataFrame:
    return _coded_days(date_dim, holidays, months_after(p.as_of, -12 * p.history_years),
                       lit_date(p.as_of))


def forecast_days(date_dim: DataFrame, holidays: DataFrame, p: Params) -> DataFrame:
    return _coded_days(date_dim, holidays, lit_date(p.as_of),
                       months_after(p.as_of, p.horizon_months))


def fuec_seasonal_mean(encounters: DataFrame, date_dim: DataFrame, holidays: DataFrame,
                       p: Params) -> DataFrame:
    """(keys..., month, dayofweek, patients): positive mean daily arrivals."""
    days = history_days(date_dim, holidays, p)   # <= 366 * history_years rows
    arr = fuec_daily_arrivals(encounters, p)   # keys are non-NULL by construction
    per_day = (arr.join(F.broadcast(days.select("day", "month", "dayofweek")),
                        arr.admit_date == F.col("day"))
               .groupBy("day", "month", "dayofweek", *KEYS)
               .agg(F.sum("patients").alias("_a"), F.count(F.lit(1)).alias("_m")))
    per_combo = (per_day.groupBy(*KEYS, "month", "dayofweek")
                 .agg(F.sum("_a").alias("_a"), F.sum(F.col("_m") - 1).alias("_x")))
    n_days = days.groupBy("month", "dayofweek").agg(F.count(F.lit(1)).alias("_d"))  # <= 96 rows
    mean = F.col("_a").cast("double") / (F.col("_d") + F.col("_x"))
    return (per_combo.join(F.broadcast(n_days), ["month", "dayofweek"])
            .select(*KEYS, "month", "dayofweek", mean.alias("patients"))
            .where(F.col("patients") > 0))


# ----------------------------------------------------------- forecast -------
def fuec_forecast(encounters: DataFrame, date_dim: DataFrame, holidays: DataFrame,
                  p: Params) -> DataFrame:
    """The 16 FUEC columns in working types (cast by ``sinks.conform``)."""
    require_calendar(date_dim, p)
    curves = fuec_curves(encounters, p).select(*[F.col(c).alias(f"_c_{c}") for c in FEATURES],
                                            "max_los", "s", "total", "expected_los")
    # One seasonal-mean row per cohort; its curve joins 1:1 (NULL if none, N9).
    # Null-safe equality gives the same result here (seasonal rows have no
    # NULL key) and infers no extra isnotnull filters into the curve branch.
    sm = fuec_seasonal_mean(encounters, date_dim, holidays, p)
    on = [sm[c].eqNullSafe(curves[f"_c_{c}"]) for c in FEATURES]
    ep = sm.join(curves, on, "left").drop(*[f"_c_{c}" for c in FEATURES])
    # ep (keys x combos, with curves) feeds both the grid and the per-combo
    # counts; it is small, so it is materialised once in the shared
    # checkpoint folder: the encounters are read once for it, and a lost
    # executor later recomputes from here, not from the scans.
    ep = stage(ep, "fuec_seasonal_curves")
    # dense_rank over (day, keys) = keys on earlier days + rank within the
    # day.  A day's keys are those of its (month, weekday code) combo, so the
    # rank within the day is the key's place among its combo's seasonal rows:
    # its global position in (combo, keys) minus the combo's first one.
    ep = positions(ep, ["month", "dayofweek", *KEYS], "_at")
    combo_n = ep.groupBy("month", "dayofweek").agg(                             # <= 96 rows
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    days = forecast_days(date_dim, holidays, p)                                # <= 31 * horizon rows
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (days.join(F.broadcast(combo_n), ["month", "dayofweek"], "left")
               .select("day", "day_of_week", "month", "dayofweek", "_first",
                       F.coalesce(F.sum(F.coalesce("_n", F.lit(0))).over(earlier), F.lit(0))
                       .alias("_off")))
    # ep is a small aggregate (AQE keeps few partitions), but each row expands
    # to ~days x max LOS output rows: spread it over the cluster's cores first.
    ep = ep.repartition(encounters.sparkSession.sparkContext.defaultParallelism, *KEYS)
    grid = ep.join(F.broadcast(offsets), ["month", "dayofweek"])              # (day, key) rows

    d = F.col("beddeddays")
    exploded = grid.select("*", F.explode_outer(F.sequence(F.lit(1), F.col("max_los"))).alias("beddeddays"))
    return exploded.select(
        "day",
        F.col("dayofweek").cast("int").alias("dayofweek"),
        "day_of_week",
        F.col("month").cast("int").alias("month"),
        "service_name", "service_code",
        F.col("patients").cast("double").alias("patients"),
        d.cast("int").alias("beddeddays"),
        (F.try_element_at(F.col("s"), d) / F.col("total")).alias("stay_rate"),
        "admit_type", "location", "site_desc",
        (F.col("_off") + F.col("_at") - F.col("_first") + 1).cast("string").alias("stay_key"),
        F.coalesce(d, F.lit(1)).cast("int").alias("stay_key_seq"),
        F.col("expected_los").cast("double").alias("expected_los"),
        lit_ts_ntz(p.run_ts).alias("update_dttm"),
    )

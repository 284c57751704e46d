"""Model monitoring: dictionary, accuracy and column profiles (M8-M10), plus
the seasonal LOS percentile (A12).

The dashboard these feed exists only as prose upstream; the definitions
here are ours and are stated in each docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedflow.config import FUEC_ADMIT_TYPES
from bedflow.operators.survival import past_stays
from bedflow.operators.sweep import census

# Care classes of the commented-out percentile estimate.
PERCENTILE_CARE_CLASSES = ("Inpatient", "Observation")


def model_dictionary(models: DataFrame) -> DataFrame:
    """One row per (model_name, model_source, model_sequence) of the common
    format: first/last run, rows, distinct stays, covered date range."""
    return (models.groupBy("model_name", "model_source", "model_sequence")
            .agg(F.min("model_timestamp").alias("first_run"),
                 F.max("model_timestamp").alias("last_run"),
                 F.count(F.lit(1)).alias("n_rows"),
                 F.count_distinct("stay_key").alias("n_stays"),
                 F.min("stay_start_date").alias("first_day"),
                 F.max("stay_end_date").alias("last_day"),
                 (F.count(F.lit(1)) - F.count("stay_rate")).alias("n_unrated")))


def column_profile(df: DataFrame) -> DataFrame:
    """(column_name, data_type, n_rows, n_nulls, n_distinct, min_value, max_value).

    Counts, min and max come from one typed aggregation (map-side partial
    aggregates).  Exact distinct counts unpivot the columns to (column,
    value) and aggregate twice, so the shuffle carries distinct values per
    partition, not rows, and no column is held by a single task.
    """
    cols = df.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.count(F.col(c)).alias(f"_c{i}"),
                 F.min(c).cast("string").alias(f"_lo{i}"),
                 F.max(c).cast("string").alias(f"_hi{i}")]
    stats = df.agg(*aggs)
    per_col = stats.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
                 F.col("_n").alias("n_rows"),
                 (F.col("_n") - F.col(f"_c{i}")).alias("n_nulls"),
                 F.col(f"_lo{i}").alias("min_value"),
                 F.col(f"_hi{i}").alias("max_value"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in cols])).alias("p")).select("p.*").where(F.col("value").isNotNull())
    distinct = pairs.distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    return (per_col.join(distinct, "column_name", "left")
            .select("column_name", "data_type", "n_rows", "n_nulls",
                    F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
                    "min_value", "max_value"))


def column_quantiles(df: DataFrame, columns: list[str], by: list[str] | None = None,
                     exact: bool = False) -> DataFrame:
    """Per numeric column (and group): n, mean, sample stddev, min, quartiles,
    max; moments rounded to 9 places.

    Quartiles come from a sketch of bounded size; ``exact`` (linear
    interpolation) keeps a value -> count map per group and is for columns with
    few distinct values, such as a length of stay.
    """
    by = by or []
    parts = []
    for c in columns:
        x = F.col(c).cast("double")

        def quantile(q: float):
            return F.percentile(x, F.lit(q)) if exact else F.percentile_approx(x, q, 10_000)
        parts.append(df.groupBy(*by).agg(
            F.lit(c).alias("column_name"),
            F.count(x).alias("n"),
            (F.round(F.avg(x), 9) + 0.0).alias("mean"),
            (F.round(F.stddev_samp(x), 9) + 0.0).alias("stddev"),
            F.min(x).alias("min"),
            quantile(0.25).alias("p25"), quantile(0.5).alias("p50"), quantile(0.75).alias("p75"),
            F.max(x).alias("max")))
    out = parts[0]
    for extra in parts[1:]:
        out = out.unionByName(extra)
    return out


def column_distribution(df: DataFrame, categorical: list[str], numeric: list[str], bins: int = 10) -> DataFrame:
    """(column_name, kind, bucket, n, share): frequencies of the values of
    categorical columns, and histograms of numeric ones over ``bins`` equal
    widths between minimum and maximum, named by their number from 1.  A NULL
    has the bucket 'NULL'; ``share`` is of all rows, so a NULL bucket's share is
    the column's null rate.

    One pass finds the ranges (one row), one counts (column, bucket) pairs,
    combined map-side.
    """
    total, *ends = df.agg(F.count(F.lit(1)), *[f(F.col(c).cast("double")) for c in numeric
                                               for f in (F.min, F.max)]).first()
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit("category").alias("kind"),
                      F.coalesce(F.col(c).cast("string"), F.lit("NULL")).alias("bucket")) for c in categorical]
    for c, low, high in zip(numeric, ends[::2], ends[1::2]):
        x = F.col(c).cast("double")
        width = ((high - low) / bins if low is not None else 0.0) or 1.0
        number = F.when(x.isNotNull(), F.least(F.floor((x - F.lit(low or 0.0)) / width), F.lit(bins - 1)) + 1)
        cells.append(F.struct(F.lit(c).alias("column_name"), F.lit("histogram").alias("kind"),
                              F.coalesce(number.cast("string"), F.lit("NULL")).alias("bucket")))
    pairs = df.select(F.explode(F.array(*cells)).alias("x")).select("x.*")
    counts = pairs.groupBy("column_name", "kind", "bucket").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.lit(float(total or 1)), 9))


def column_estimates(df: DataFrame) -> DataFrame:
    """(column_name, null_rate, approx_distinct): one pass with sketches, for
    columns whose exact distinct count is not worth a shuffle."""
    aggs = [x for i, c in enumerate(df.columns) for x in (
        (1 - F.count(F.col(c)) / F.count(F.lit(1))).alias(f"_z{i}"), F.approx_count_distinct(c).alias(f"_d{i}"))]
    return df.agg(*aggs).select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(f"_z{i}").alias("null_rate"), F.col(f"_d{i}").alias("approx_distinct"))
        for i, c in enumerate(df.columns)])).alias("x")).select("x.*")


def census_accuracy(models: DataFrame, stays: DataFrame) -> DataFrame:
    """Predicted against realised bed-days, per model and day (M9).

    ``models`` is in the common format; a day's prediction is the sum of
    num_of_patient x stay_rate of the rows that start on it (unrated rows add
    nothing).  ``stays`` (stay_key, admit_date, beddeddays) tells how long the
    stays really lasted; a model's realised bed-days count those of its own
    patients who were in bed that day.  Sums are rounded to 6 places.
    """
    predicted = models.groupBy("model_name", "stay_start_date").agg(
        F.sum(F.coalesce(F.col("num_of_patient") * F.col("stay_rate"), F.lit(0.0))).alias("predicted"),
        F.count(F.lit(1)).alias("n_rows"))
    patients = models.select("model_name", "stay_key").distinct().join(stays, "stay_key")
    realised = census(patients, ["model_name"]).select(
        "model_name", F.col("day").alias("stay_start_date"), F.col("census").alias("realised"))
    joined = predicted.join(realised, ["model_name", "stay_start_date"], "left")
    actual = F.coalesce("realised", F.lit(0))
    return joined.select(
        "model_name", "stay_start_date", "n_rows",
        (F.round("predicted", 6) + 0.0).alias("predicted_bed_days"), actual.alias("realised_bed_days"),
        (F.round(F.col("predicted") - actual, 6) + 0.0).alias("error"))


def los_percentile_by_season(encounters: DataFrame, q: float = 0.6) -> DataFrame:
    """Rounded exact percentile (linear interpolation, as percentile_cont)
    of LOS by service, month and weekday of urgent past stays.  Spark's exact
    percentile keeps a value -> count map, bounded by distinct LOS values."""
    stays = past_stays(encounters).where(
        F.col("admit_type").isin(*FUEC_ADMIT_TYPES)
        & F.col("care_class").isin(*PERCENTILE_CARE_CLASSES))
    return (stays.groupBy("service_name", F.month("admit_date").alias("month"),
                          F.dayofweek("admit_date").alias("dayofweek"))
            .agg(F.round(F.percentile("beddeddays", F.lit(q)), 0).alias("beddeddays")))


def seasonal_fit(seasonal_mean: DataFrame, daily_arrivals: DataFrame,
                      history_days: DataFrame, keys: list[str]) -> DataFrame:
    """Fit of the FUEC seasonal mean to the very arrivals it was averaged from,
    per key: a goodness of fit, not the accuracy of a forecast.

    Cells are (history day, key); the prediction for a cell is the key's mean
    for the day's (month, weekday code), 0 if it has none; the actual is the
    day's weighted arrivals (0 if none).  Returns n_days, bias = mean(actual
    - predicted), mae, rmse, rounded to 9 places.  Zero-arrival days enter
    in closed form (count x mean), so no day x key grid is built.
    """
    days = history_days.select("day", "month", "dayofweek")
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    daily_arrivals = daily_arrivals.where(not_null)
    n_days = days.groupBy("month", "dayofweek").agg(F.count(F.lit(1)).alias("_d"))
    actual = (daily_arrivals.join(F.broadcast(days), daily_arrivals.admit_date == days.day)
              .groupBy("day", "month", "dayofweek", *keys)
              .agg(F.sum("patients").cast("double").alias("_a")))
    m = seasonal_mean.select(*keys, "month", "dayofweek", F.col("patients").alias("_m"))
    cells = actual.join(m, [*keys, "month", "dayofweek"], "left").withColumn(
        "_m", F.coalesce("_m", F.lit(0.0)))
    e = F.col("_a") - F.col("_m")
    per_combo = (cells.groupBy(*keys, "month", "dayofweek")
                 .agg(F.sum(e).alias("_se"), F.sum(F.abs(e)).alias("_sa"),
                      F.sum(e * e).alias("_s2"), F.count(F.lit(1)).alias("_k"),
                      F.max("_m").alias("_m"))
                 .join(F.broadcast(n_days), ["month", "dayofweek"]))
    zero_days = F.col("_d") - F.col("_k")
    per_key = per_combo.groupBy(*keys).agg(
        F.sum(F.col("_se") - zero_days * F.col("_m")).alias("_se"),
        F.sum(F.col("_sa") + zero_days * F.col("_m")).alias("_sa"),
        F.sum(F.col("_s2") + zero_days * F.col("_m") * F.col("_m")).alias("_s2"))
    total_days = days.agg(F.count(F.lit(1)).alias("n_days")).select("n_days").scalar()
    n = total_days.cast("double")
    return per_key.select(
        *keys, total_days.alias("n_days"),
        # "+ 0.0" turns a rounded -0.0 into 0.0
        (F.round(F.col("_se") / n, 9) + 0.0).alias("bias"),
        (F.round(F.col("_sa") / n, 9) + 0.0).alias("mae"),
        (F.round(F.sqrt(F.col("_s2") / n), 9) + 0.0).alias("rmse"))

"""Empirical length-of-stay survival curves.

The models ask, for a cohort of past stays, "of the stays that reached day
``f``, what share reached day ``d``?" = S(d) / S(f), where S(d) is the number
of past stays with LOS >= d.  The original SQL answers it with a scaffold of
calendar days self-joined on ``>=`` (max LOS squared rows per cohort, or
calendar squared for the pooled model) and three window sums.  Here:

* the histogram is a map-side-combined ``groupBy(cohort, LOS).count()`` --
  the only step whose input grows with the number of stays;
* each cohort's histogram (one entry per distinct LOS value, so bounded by
  the LOS range, not by the number of stays) is gathered into one row and
  S(1..max) is computed there with JVM-side higher-order functions;
* the per-patient expansion then looks rates up in that array, so no curve
  table is ever joined to patient-day rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedflow.config import PAST


def past_stays(encounters: DataFrame) -> DataFrame:
    return encounters.where((F.col("patient_type") == PAST) & (F.col("beddeddays") > 0))


def require_unique(rows: DataFrame, key: str) -> None:
    """Raise if a ``key`` occurs twice (one row of counts reaches the driver)."""
    twice = rows.groupBy(key).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{key} is not unique, e.g. {twice[0][0]!r}")


def los_histogram(stays: DataFrame, cohort: Sequence[str]) -> DataFrame:
    """(cohort..., beddeddays, patients): count of past stays per LOS.

    ``stays`` must already be restricted to the past stays of interest.
    Rows with a NULL cohort value are dropped: every later join on the
    cohort is an equality join and could never match them.
    """
    keep = F.lit(True)
    for c in cohort:
        keep = keep & F.col(c).isNotNull()
    return (stays.where(keep)
            .groupBy(*cohort, "beddeddays")
            .agg(F.count(F.lit(1)).alias("patients")))


def stay_histogram(encounters: DataFrame) -> DataFrame:
    """(service_code, beddeddays, patients) of all past stays, services
    without a code included: the one history scan from which the LOS feature
    and the curves of CP(C) and ED(C) derive."""
    return (past_stays(encounters).groupBy("service_code", "beddeddays")
            .agg(F.count(F.lit(1)).alias("patients")))


def curve_arrays(hist: DataFrame, cohort: Sequence[str],
                 max_los: DataFrame | None = None) -> DataFrame:
    """(cohort..., max_los, s, total, expected_los): one row per cohort.

    ``s[d-1]`` = S(d) for d = 1..max_los, NULL where no stay reached d;
    ``total`` = S(1); ``expected_los`` = sum_d S(d) / S(1) = the mean LOS = the
    sum of the day rates from day 1.  ``max_los`` (cohort..., max_los), e.g. a
    published LOS feature, bounds the curve: stays longer than it are ignored,
    days beyond the longest stay have no survivors.  With no cohort this is a
    global aggregate: always one row (NULLs without history).
    """
    cohort = list(cohort)
    entries = F.collect_list(F.struct(F.col("beddeddays").cast("int").alias("los"),
                                      F.col("patients").cast("long").alias("n")))
    g = hist.groupBy(*cohort) if cohort else hist
    c = g.agg(F.array_sort(entries).alias("_h"), F.max("beddeddays").cast("int").alias("max_los"))
    if max_los is not None:
        c = c.drop("max_los").join(max_los.select(*cohort, F.col("max_los").cast("int")), cohort)
    # one step per distinct LOS: how many stays are at least that long
    c = c.withColumn("_h", F.expr("filter(_h, e -> e.los <= max_los)"))
    at_least = ("aggregate(_h, named_struct('left', aggregate(_h, 0L, (a, e) -> a + e.n), 'out', "
                "CAST(array() AS ARRAY<BIGINT>)), (a, e) -> named_struct('left', a.left - e.n, "
                "'out', array_append(a.out, a.left)), a -> a.out)")
    # each value holds from the day after the next shorter LOS
    reached = ("flatten(transform(_h, (e, i) -> array_repeat(_r[i], "
               "e.los - IF(i = 0, 0, try_element_at(_h, i).los))))")
    full = F.expr(f"IF(max_los >= 1, concat({reached}, array_repeat(CAST(NULL AS BIGINT), "
                  f"max_los - coalesce(try_element_at(_h, -1).los, 0))), NULL)")
    return (c.withColumn("_r", F.expr(at_least)).select(*cohort, "max_los", full.alias("s"))
            .withColumn("total", F.element_at("s", 1))
            .withColumn("expected_los", F.expr("aggregate(s, 0L, (a, x) -> a + coalesce(x, 0L)) / total")))


def survival_curve(hist: DataFrame, cohort: Sequence[str],
                   max_los: DataFrame | None = None) -> DataFrame:
    """(cohort..., stay_day, patients, at_risk, total) for stay_day = 1..max:
    the tabular form of ``curve_arrays`` (at_risk = S(stay_day), NULL at zero)."""
    cohort = list(cohort)
    arr = curve_arrays(hist, cohort, max_los)
    day = F.col("_pos") + 1
    nxt = F.coalesce(F.try_element_at(F.col("s"), (day + 1).cast("int")), F.lit(0).cast("long"))
    return (arr.select(*cohort, "s", "total", F.posexplode("s").alias("_pos", "at_risk"))
            .select(*cohort, day.cast("int").alias("stay_day"),
                    (F.coalesce("at_risk", F.lit(0).cast("long")) - nxt).alias("patients"), "at_risk", "total"))


def rate_at(s: Column, day: Column, given: Column) -> Column:
    """S(day) / S(given); NULL where either day is outside the curve."""
    return F.try_element_at(s, day.cast("int")) / F.try_element_at(s, given.cast("int"))


def conditional_rates(arrays: DataFrame, cohort: Sequence[str]) -> DataFrame:
    """(cohort..., days_stayed, stay_day, stay_rate) for 1 <= f <= d <= max.

    The full table the original self-join materialises; the models never
    build it, they look rates up per patient.
    """
    f = F.explode(F.sequence(F.lit(1), F.col("max_los"))).alias("days_stayed")
    # The arrays come from a small aggregate (few partitions after AQE) but
    # expand to max^2/2 rows per cohort: spread the first level over the
    # cluster's cores before the second explode.
    parallelism = arrays.sparkSession.sparkContext.defaultParallelism
    base = (arrays.where(F.col("max_los") >= 1).select(*cohort, "s", "max_los", f)
            .repartition(parallelism, *cohort, "days_stayed"))
    d = F.explode(F.sequence(F.col("days_stayed"), F.col("max_los"))).alias("stay_day")
    return (base.select(*cohort, "s", "days_stayed", d)
            .select(*cohort, "days_stayed", "stay_day",
                    rate_at(F.col("s"), F.col("stay_day"), F.col("days_stayed")).alias("stay_rate")))

"""CP(C): day-by-day probability that each current inpatient is still bedded.

Cohort = service.  For a current patient who has stayed f days, the rate of
still being here on stay day d (f <= d <= the service's max past LOS, start
before as_of + horizon) is S(d) / S(f).  The days already stayed are
backfilled with rate 1.  Patients with no curve (f beyond the max) get no
rows at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bedflow.config import CPC_MODEL_NAME, CURRENT, EMERGENCY_CARE_CLASS, Params
from bedflow.operators import stays as S
from bedflow.operators.survival import curve_arrays, stay_histogram
from bedflow.plans.common import common_format

COHORT = ["service_code"]


def current_inpatients(encounters: DataFrame) -> DataFrame:
    return encounters.where((F.col("patient_type") == CURRENT)
                            & (F.col("beddeddays") > 0)
                            & (F.col("care_class") != EMERGENCY_CARE_CLASS))


def cpc_curves(hist: DataFrame, los: DataFrame | None = None) -> DataFrame:
    """Per-service curve arrays of a ``stay_histogram``; ``los`` (a published
    LOS feature) bounds the curve, else the histogram's own maximum."""
    max_los = None
    if los is not None:
        max_los = los.select("service_code", F.col("max_bedded_day").alias("max_los"))
    return curve_arrays(hist.where(F.col("service_code").isNotNull()), COHORT, max_los)


def _patients(encounters: DataFrame, curves: DataFrame) -> DataFrame:
    cur = current_inpatients(encounters).select(
        F.col("contact_serial_number").alias("stay_key"), "admit_date", "beddeddays",
        F.col("patient_type").alias("patient_timeframe"), "service_code")
    # Inner join: a patient whose service has no curve gets no rows (N1).
    # The curve table is one row per service; AQE broadcasts it when small.
    return cur.join(curves.select("service_code", "s", "max_los"), "service_code")


def _rows(encounters: DataFrame, p: Params, los: DataFrame | None, hist: DataFrame | None,
          future: bool, backfill: bool) -> DataFrame:
    pts = _patients(encounters, cpc_curves(stay_histogram(encounters) if hist is None else hist, los))
    last = F.least(F.col("max_los"), S.horizon_last_day(p, F.col("admit_date")))
    rows = S.stay_days(pts, last, p, ["stay_key", "patient_timeframe"], future, backfill)
    return common_format(rows, p, CPC_MODEL_NAME, F.lit(1))


def cpc_future(encounters: DataFrame, p: Params, los: DataFrame | None = None,
               hist: DataFrame | None = None) -> DataFrame:
    return _rows(encounters, p, los, hist, future=True, backfill=False)


def cpc_backfill(encounters: DataFrame, p: Params, los: DataFrame | None = None,
                 hist: DataFrame | None = None) -> DataFrame:
    return _rows(encounters, p, los, hist, future=False, backfill=True)


def cpc_model(encounters: DataFrame, p: Params, los: DataFrame | None = None,
              hist: DataFrame | None = None) -> DataFrame:
    """Backfill and future rows of every current inpatient, in the common
    format, from one join and one expansion.  ``hist`` is a staged
    ``stay_histogram``, where several models share it."""
    return _rows(encounters, p, los, hist, future=True, backfill=True)

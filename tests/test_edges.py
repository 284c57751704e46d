"""Edge cases on tiny literal encounter tables."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bedflow.operators.survival import (conditional_rates, curve_arrays, los_histogram,
                                        past_stays, survival_curve)
from bedflow.plans import cpc, edc, fuec
from bedflow.sources.calendar import date_dim, holiday_dim
from bedflow.sources.fixtures import FIXTURE_PARAMS as P
from tests.conftest import enc_row

AS_OF = P.as_of


def _rate_df(spark, value):
    return spark.createDataFrame([(value,)], "ed_reclassification_rate double")


def test_curve_with_gaps(make_encounters):
    rows = [enc_row(i, "1999-01-01", "Past", los) for i, los in enumerate([1, 3, 3, 5])]
    curve = survival_curve(los_histogram(past_stays(make_encounters(rows)), ["service_code"]),
                           ["service_code"]).orderBy("stay_day").collect()
    assert [r.stay_day for r in curve] == [1, 2, 3, 4, 5]
    assert [r.at_risk for r in curve] == [4, 3, 3, 1, 1]
    assert {r.total for r in curve} == {4}


def test_brute_force_conditional_rates(make_encounters):
    """Rewritten rates == the quadratic self-join of the original, computed
    by brute force over random histograms with gaps."""
    rng = random.Random(7)
    rows = []
    for i in range(300):
        svc = rng.choice(["A", "B", "C"])
        rows.append(enc_row(i, "1998-05-01", "Past", rng.choice([0, 1, 2, 2, 4, 7, 7, 9, 12]), service=svc))
    enc = make_encounters(rows)
    arrays = curve_arrays(los_histogram(past_stays(enc), ["service_code"]), ["service_code"])
    got = {(r.service_code, r.days_stayed, r.stay_day): r.stay_rate
           for r in conditional_rates(arrays, ["service_code"]).collect()}
    want = {}
    for svc in "ABC":
        los = [r[4] for r in rows if r[5] == svc and r[4] > 0]
        mx = max(los)
        for f in range(1, mx + 1):
            for d in range(f, mx + 1):
                running = sum(1 for x in los if x >= d)
                total = sum(1 for x in los if x >= f)
                want[(svc, f, d)] = running / total
    assert got == want


def test_single_past_patient(make_encounters):
    rows = [enc_row(1, "1999-01-01", "Past", 2),
            enc_row(2, AS_OF - dt.timedelta(days=1), "Current", 1)]
    out = cpc.cpc_future(make_encounters(rows), P).orderBy("stay_key_seq").collect()
    assert [(r.stay_key_seq, r.stay_rate) for r in out] == [(1, 1.0), (2, 1.0)]


def test_los_beyond_max_dropped_by_cpc_null_in_edc(make_encounters, spark):
    rows = [enc_row(i, "1999-01-01", "Past", los) for i, los in enumerate([1, 2, 5])]
    admit = AS_OF - dt.timedelta(days=7)
    rows += [enc_row(100, admit, "Current", 7, care_class="Inpatient"),
             enc_row(101, admit, "Current", 7, care_class="Emergency")]
    enc = make_encounters(rows)
    assert cpc.cpc_model(enc, P).count() == 0
    out = edc.edc_future(enc, _rate_df(spark, 0.5), P).toPandas()
    assert len(out) > 0 and out.stay_rate.isna().all()
    horizon_days = (dt.date(2000, 4, 15) - admit).days
    assert out.stay_key_seq.max() == horizon_days and out.stay_key_seq.min() == 7
    assert edc.edc_backfill(enc, _rate_df(spark, 0.5), P).count() == 7 - 1


def test_empty_input(make_encounters, spark):
    enc = make_encounters([])
    assert cpc.cpc_model(enc, P).count() == 0
    assert edc.edc_model(enc, P, rate=_rate_df(spark, 0.5)).count() == 0
    cal, hol = date_dim(spark, P), holiday_dim(spark, P)
    assert fuec.fuec_forecast(enc, cal, hol, P).count() == 0


def test_no_history_edc_rows_are_unrated(make_encounters, spark):
    rows = [enc_row(1, AS_OF - dt.timedelta(days=2), "Current", 2, care_class="Emergency")]
    out = edc.edc_future(make_encounters(rows), _rate_df(spark, 0.5), P).toPandas()
    assert len(out) > 0 and out.stay_rate.isna().all()


def test_no_reclassification_rows_gives_null_rate(spark):
    from bedflow.schemas import CAKE_SNAPSHOT
    snaps = spark.createDataFrame([], CAKE_SNAPSHOT)
    rate = edc.ed_reclassification_rate(snaps, P).collect()
    assert len(rate) == 1 and rate[0].ed_reclassification_rate is None


def test_reclassification_rate_rules(spark):
    from bedflow.schemas import CAKE_SNAPSHOT
    d = dt.date
    snaps = spark.createDataFrame([
        ("a", d(2000, 1, 1), d(2000, 1, 2), "CP(C)", "ED Admit", -1),   # next day: not reclassified
        ("b", d(2000, 1, 1), d(2000, 1, 4), "CP(C)", "ED Admit", -1),   # 3 days: reclassified
        ("c", d(2000, 1, 1), d(2000, 1, 9), "CP(C)", "ED Admit", -1),   # > 5 days: excluded
        ("d", d(1999, 11, 1), d(1999, 11, 2), "CP(C)", "ED Admit", -1), # before the month: excluded
        ("e", d(2000, 1, 1), d(2000, 1, 3), "CP(C)", "Transfer", -1),   # other category
    ], CAKE_SNAPSHOT)
    assert edc.ed_reclassification_rate(snaps, P).collect()[0][0] == 0.5


def test_backfill_guard_for_recent_admission(make_encounters):
    rows = [enc_row(1, "1999-01-01", "Past", 3),
            enc_row(2, AS_OF - dt.timedelta(days=1), "Current", 1)]
    assert cpc.cpc_backfill(make_encounters(rows), P).count() == 0


def test_holiday_weekday_code(spark):
    days = fuec.forecast_days(date_dim(spark, P), holiday_dim(spark, P.with_(as_of=dt.date(1999, 12, 20))),
                              P.with_(as_of=dt.date(1999, 12, 20))).collect()
    codes = {r.day: r.dayofweek for r in days}
    assert codes[dt.date(1999, 12, 25)] == 9
    assert codes[dt.date(1999, 12, 26)] == 1  # Sunday


def test_duplicate_raw_locations_fan_out(make_encounters, spark):
    """N5: two raw locations fold to one key; parity keeps both key rows and
    the per-location daily rows, which changes the average."""
    day = dt.date(1999, 12, 6)  # a Monday inside the history window
    base = dict(admit_type="Urgent", care_class="Inpatient")
    rows = [enc_row(1, day, "Past", 2, location="Ward A", **base),
            enc_row(2, day, "Past", 3, location="Ward B", **base)]
    enc = make_encounters(rows)
    keys = fuec.fuec_service_keys(enc, P).collect()
    assert len(keys) == 2 and {k.location for k in keys} == {"Occupied Bed"}
    cal, hol = date_dim(spark, P), holiday_dim(spark, P)
    parity = fuec.fuec_seasonal_mean(enc, cal, hol, P).collect()
    folded = fuec.fuec_seasonal_mean(enc, cal, hol, P.with_(fold_first=True)).collect()
    n_days = fuec.history_days(cal, hol, P).where((F.month("day") == 12) & (F.col("dayofweek") == 2)).count()
    assert folded[0].patients == pytest.approx(2 / n_days)
    assert parity[0].patients == pytest.approx(2 / (n_days + 1))


def test_sequence_never_counts_down(make_encounters):
    # f beyond the horizon: no rows (sequence(f, last) with last < f is filtered)
    rows = [enc_row(1, "1999-01-01", "Past", 200),
            enc_row(2, "1999-12-01", "Current", 150)]
    assert cpc.cpc_future(make_encounters(rows), P).count() == 0


def test_published_max_truncates_curve(make_encounters):
    """A published max LOS below the data's max bounds the curve exactly as
    a scaffold of 1..max left-joined to the histogram would."""
    rows = [enc_row(i, "1999-01-01", "Past", los) for i, los in enumerate([1, 2, 2, 3, 6])]
    enc = make_encounters(rows)
    feature = enc.sparkSession.createDataFrame([("SURG", 3)], "service_code string, max_los int")
    arr = curve_arrays(los_histogram(past_stays(enc), ["service_code"]), ["service_code"], feature).collect()[0]
    assert arr.max_los == 3 and arr.s == [4, 3, 1]


def test_empty_rate_table_gives_no_edc_rows(make_encounters, spark):
    rows = [enc_row(1, "1999-01-01", "Past", 3),
            enc_row(2, AS_OF - dt.timedelta(days=2), "Current", 2, care_class="Emergency")]
    empty = spark.createDataFrame([], "ed_reclassification_rate double")
    assert edc.edc_model(make_encounters(rows), P, rate=empty).count() == 0
    assert edc.edc_model(make_encounters(rows), P, rate=_rate_df(spark, 0.5)).count() > 0


def test_run_timestamp_ignores_session_time_zone(spark, make_encounters):
    from bedflow.functions.dates import lit_ts_ntz
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = spark.range(1).select(lit_ts_ntz(dt.datetime(2000, 1, 15, 4, 0)).alias("t")).first().t
        assert got == dt.datetime(2000, 1, 15, 4, 0)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("as_of, admit, days", [(dt.date(2026, 1, 15), dt.date(2026, 1, 5), 9),
                                                (dt.date(2000, 1, 15), dt.date(1994, 6, 1), 2053)])
def test_no_calendar_bounds_the_backfill(make_encounters, as_of, admit, days):
    p = P.with_(as_of=as_of)
    rows = [enc_row(1, "1993-01-01", "Past", 4000),
            enc_row(2, admit, "Current", (as_of - admit).days),
            enc_row(3, admit, "Current", (as_of - admit).days, care_class="Emergency")]
    enc = make_encounters(rows)
    got = cpc.cpc_backfill(enc, p).orderBy("stay_key_seq").collect()
    assert len(got) == days and got[0].stay_start_date == admit
    assert got[-1].stay_start_date == as_of - dt.timedelta(days=2) and got[-1].stay_key_seq == days
    spark = enc.sparkSession
    assert edc.edc_backfill(enc, _rate_df(spark, 0.5), p).count() == days
    assert edc.edc_future(enc, _rate_df(spark, 0.5), p).count() > 80


def test_no_survivors_give_null_rates(make_encounters):
    """A published maximum beyond the history: NULL, not 0 and no error."""
    rows = [enc_row(i, "1999-01-01", "Past", los) for i, los in enumerate([2, 4, 10])]
    rows += [enc_row(10, AS_OF - dt.timedelta(days=5), "Current", 5),
             enc_row(11, AS_OF - dt.timedelta(days=12), "Current", 12)]
    enc = make_encounters(rows)
    los = enc.sparkSession.createDataFrame([("SURG", 20)], "service_code string, max_bedded_day int")
    got = {(r.stay_key, r.stay_key_seq): r.stay_rate for r in cpc.cpc_future(enc, P, los=los).collect()}
    assert got == {("10", d): 1.0 if d <= 10 else None for d in range(5, 21)} | {("11", d): None for d in range(12, 21)}


def test_unrated_tail_off_without_history_gives_no_rows(make_encounters, spark):
    rows = [enc_row(1, AS_OF - dt.timedelta(days=2), "Current", 2, care_class="Emergency")]
    p = P.with_(keep_unrated_tail=False)
    assert edc.edc_model(make_encounters(rows), p, rate=_rate_df(spark, 0.5)).count() == 0


def test_curve_of_gaps_and_limits(make_encounters):
    rng = random.Random(3)
    for _ in range(5):
        los = [rng.choice([1, 2, 5, 9, 9, 30]) for _ in range(rng.randint(1, 12))]
        enc = make_encounters([enc_row(i, "1999-01-01", "Past", x) for i, x in enumerate(los)])
        hist = los_histogram(past_stays(enc), ["service_code"])
        for top in (1, 4, 9, 40):
            feature = enc.sparkSession.createDataFrame([("SURG", top)], "service_code string, max_los int")
            got = curve_arrays(hist, ["service_code"], feature).first()
            kept = [x for x in los if x <= top]
            assert got.s == [sum(x >= d for x in kept) or None for d in range(1, top + 1)]
            if kept:
                assert got.expected_los == pytest.approx(sum(kept) / len(kept))


def test_short_calendar_is_told(make_encounters, spark):
    p = P.with_(as_of=dt.date(2010, 5, 1))
    with pytest.raises(ValueError, match="calendar"):
        fuec.fuec_forecast(make_encounters([]), date_dim(spark, P), holiday_dim(spark, P), p)


def test_dates_and_site_have_no_defaults():
    from bedflow.config import Params
    with pytest.raises(TypeError):
        Params()


def test_repeated_serial_numbers_are_told(make_encounters):
    from bedflow.operators.survival import require_unique
    rows = [enc_row(1, "1999-01-01", "Past", 2), enc_row(1, "1999-01-02", "Past", 3)]
    with pytest.raises(ValueError, match="not unique"):
        require_unique(make_encounters(rows), "contact_serial_number")

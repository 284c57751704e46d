"""Property test: CP(C) future rows against a brute-force rendering of the
original semantics (scaffold 1..max per service, rate = S(d)/S(f), rows for
f <= d <= max with start before the horizon) on random inputs."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bedflow.plans import cpc
from bedflow.sources.fixtures import FIXTURE_PARAMS as P
from tests.conftest import enc_row

HORIZON = dt.date(2000, 4, 15)

past = st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 40)), min_size=1, max_size=40)
current = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(1, 120)), max_size=8)


def brute(past_rows, current_rows):
    out = {}
    for i, (svc, f) in enumerate(current_rows):
        los = [x for s, x in past_rows if s == svc and x > 0]
        if not los or f > max(los):
            continue
        admit = P.as_of - dt.timedelta(days=f)
        for d in range(f, max(los) + 1):
            if admit + dt.timedelta(days=d - 1) >= HORIZON:
                break
            out[(str(1000 + i), d)] = sum(x >= d for x in los) / sum(x >= f for x in los)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(past, current)
def test_cpc_future_matches_brute_force(make_encounters, past_rows, current_rows):
    rows = [enc_row(i, "1999-01-01", "Past", los, service=svc) for i, (svc, los) in enumerate(past_rows)]
    rows += [enc_row(1000 + i, P.as_of - dt.timedelta(days=f), "Current", f, service=svc)
             for i, (svc, f) in enumerate(current_rows)]
    got = {(r.stay_key, r.stay_key_seq): r.stay_rate
           for r in cpc.cpc_future(make_encounters(rows), P).collect()}
    assert got == brute(past_rows, current_rows)


def brute_edc(past_rows, current_rows):
    """Pooled curve; the scaffold spans every calendar day, so rows run to the
    horizon and carry a NULL rate past the observed max (or when f is past it)."""
    los = [x for _, x in past_rows if x > 0]
    mx = max(los) if los else 0
    out = {}
    for i, (_, f) in enumerate(current_rows):
        admit = P.as_of - dt.timedelta(days=f)
        d = f
        while admit + dt.timedelta(days=d - 1) < HORIZON:
            out[(str(2000 + i), d)] = (sum(x >= d for x in los) / sum(x >= f for x in los)
                                       if d <= mx and f <= mx else None)
            d += 1
    return out


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(past, current)
def test_edc_future_matches_brute_force(make_encounters, spark, past_rows, current_rows):
    from bedflow.plans import edc
    rows = [enc_row(i, "1999-01-01", "Past", los, service=svc) for i, (svc, los) in enumerate(past_rows)]
    rows += [enc_row(2000 + i, P.as_of - dt.timedelta(days=f), "Current", f, service=svc,
                     care_class="Emergency") for i, (svc, f) in enumerate(current_rows)]
    rate = spark.createDataFrame([(0.5,)], "ed_reclassification_rate double")
    got = {(r.stay_key, r.stay_key_seq): r.stay_rate
           for r in edc.edc_future(make_encounters(rows), rate, P).collect()}
    assert got == brute_edc(past_rows, current_rows)

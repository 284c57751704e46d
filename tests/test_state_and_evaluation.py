"""States kept by changes, ranks, sweeps and rolling evaluation against brute force."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bedflow.operators import evaluation, ranking, state, sweep
from bedflow.operators.survival import stay_histogram
from bedflow.sources import published
from bedflow.sources.fixtures import FIXTURE_PARAMS as P

CHANGES = "contact_serial_number string, patient_type string, service_code string, beddeddays int"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def opened(df):
    """The data folders that a plan reads."""
    return {f.split("/data/")[1].rsplit("/", 1)[0] for f in df.inputFiles()}


def hist(df):
    return {(r["service_code"], r["beddeddays"]): r["patients"] for r in df.collect()}


# --- histogram state --------------------------------------------------------------

def test_histogram_state_follows_any_history(spark, tmp_path):
    """Random days of admissions, discharges, corrections and deletions, one
    batch a day, against the histogram of the table as it is."""
    r, root, table = random.Random(4), str(tmp_path / "h"), {}
    for today in range(6):
        before = dict(table)
        for _ in range(25):
            key = str(r.randrange(60))
            if r.random() < 0.15:
                table.pop(key, None)
            else:
                table[key] = (r.choice(["Past", "Current", "Past"]), r.choice(["SURG", "MED", None]), r.choice([0, 1, 2, 9, None]))
        changed = [k for k in {*before, *table} if before.get(k) != table.get(k)]
        frames = [spark.createDataFrame([(k, *t[k]) for k in changed if k in t], CHANGES) for t in (before, table)]
        delta = state.histogram_delta(state.row_changes(*frames))
        state.apply_histogram(spark, root, delta, f"day {today}")
        state.apply_histogram(spark, root, delta, f"day {today}")  # delivered twice
        now = spark.createDataFrame([(k, *v) for k, v in table.items()], CHANGES)
        assert hist(state.histogram(spark, root)) == hist(stay_histogram(now))
    assert published.versions(spark, root)[-1] == 6


def test_histogram_change_reads_and_writes_its_services_only(spark, tmp_path):
    root = str(tmp_path / "h")
    delta = spark.createDataFrame([(f"S{i}", d, 5) for i in range(40) for d in (1, 2)], state.HISTOGRAM)
    first = state.apply_histogram(spark, root, delta, "1")
    one = spark.createDataFrame([("S7", 2, -5), ("S7", 3, 1)], state.HISTOGRAM)
    second = state.apply_histogram(spark, root, one, "2")
    changed = {p for p in second.parts if second.parts[p] != first.parts.get(p)}
    assert len(changed) == 1 and set(first.parts) == set(second.parts)
    got = hist(state.histogram(spark, root))
    assert got[("S7", 3)] == 1 and ("S7", 2) not in got and got[("S8", 2)] == 5 and len(got) == 80


def test_histogram_refuses_what_was_never_there(spark, tmp_path):
    root = str(tmp_path / "h")
    state.apply_histogram(spark, root, spark.createDataFrame([("A", 1, 2)], state.HISTOGRAM), "1")
    with pytest.raises(ValueError, match="never added"):
        state.apply_histogram(spark, root, spark.createDataFrame([("A", 1, -3)], state.HISTOGRAM), "2")
    assert hist(state.histogram(spark, root)) == {("A", 1): 2}
    state.apply_histogram(spark, root, spark.createDataFrame([("A", 1, -2)], state.HISTOGRAM), "2")
    assert hist(state.histogram(spark, root)) == {}
    empty = state.apply_histogram(spark, root, spark.createDataFrame([], state.HISTOGRAM), "3")
    assert empty.about["batches"] == ["1", "2", "3"]


def test_model_from_the_state_does_not_read_the_history(spark, tmp_path):
    """Only current patients are read from the encounters; the curves come from the state's files."""
    from bedflow.plans import cpc
    from bedflow.sources.fixtures import encounters
    from tests.conftest import SF001
    e, root = encounters(spark, SF001, P), str(tmp_path / "h")
    state.apply_histogram(spark, root, stay_histogram(e), "1")
    model = cpc.cpc_model(e, P, hist=state.histogram(spark, root))
    assert model._jdf.queryExecution().optimizedPlan().toString().count("Relation [o_orderkey") == 1
    assert model.exceptAll(cpc.cpc_model(e, P)).count() == 0 and model.count() == 70


# --- first snapshots ---------------------------------------------------------------

SNAPSHOTS = ("stay_key string, admit_date date, snapshot_date date, orig_model_name string, category_desc string, "
             "stay_date_offset int")


def snapshots(spark, rows):
    return spark.createDataFrame([(k, a, s, "CP(C)", "ED Admit", -1) for k, a, s in rows], SNAPSHOTS)


def test_first_seen_merges_in_any_order(spark, tmp_path):
    r, root, day0 = random.Random(7), str(tmp_path / "s"), dt.date(1999, 11, 20)
    rows = []
    for i in range(80):
        admitted = day0 + dt.timedelta(days=r.randrange(60))
        rows += [(str(i), admitted, admitted + dt.timedelta(days=r.randrange(1, 9))) for _ in range(r.randrange(1, 5))]
    days = sorted({s for _, _, s in rows})
    r.shuffle(days)
    for some in (days[:20], days[20:35], days[10:25], days[35:]):  # some days come twice
        state.merge_snapshots(spark, root, snapshots(spark, [x for x in rows if x[2] in some]))
    want = {}
    for k, a, s in rows:
        want[(k, a)] = min(s, want.get((k, a), s))
    assert {(x["stay_key"], x["admit_date"]): x["first_seen"] for x in state.first_seen(spark, root).collect()} == want
    other = spark.createDataFrame([("9", day0, day0, "CP(C)", "Transfer", -1), ("9", None, day0, "CP(C)", "ED Admit", -1)], SNAPSHOTS)
    version = published.versions(spark, root)[-1]
    state.merge_snapshots(spark, root, other)  # nothing to merge
    assert published.versions(spark, root)[-1] == version


def test_a_day_reads_its_months_only(spark, tmp_path):
    root = str(tmp_path / "s")
    history = [(f"k{i}", dt.date(1999, 1 + i % 12, 3), dt.date(1999, 1 + i % 12, 4)) for i in range(120)]
    state.merge_snapshots(spark, root, snapshots(spark, history))
    first = published.manifest(spark, root)
    state.merge_snapshots(spark, root, snapshots(spark, [("new", dt.date(1999, 12, 30), dt.date(2000, 1, 1))]))
    second = published.manifest(spark, root)
    changed = {p for p in second.parts if second.parts[p] != first.parts.get(p)}
    assert len(changed) == 1 and changed.pop().startswith("1999-12")
    rate = state.reclassification_rate(spark, root, P)
    folders = opened(state.first_seen(spark, root, ["1999-12", "2000-01"]))
    assert {f for f in folders if "1999-12" not in f and "2000-01" not in f} == set()
    assert rate.collect()[0][0] == 1.0  # only 'new' is in the look-back, seen two days late
    assert state.months_between(dt.date(1999, 11, 30), dt.date(2000, 1, 1)) == ["1999-11", "1999-12", "2000-01"]


def test_rate_without_a_state_is_null(spark, tmp_path):
    assert state.reclassification_rate(spark, str(tmp_path / "none"), P).collect()[0][0] is None


# --- ranks --------------------------------------------------------------------------

def test_dense_rank_equals_the_window(spark):
    r = random.Random(2)
    rows = [(i, r.choice([None, "a", "b", "c"]), r.choice([None, 1, 2, 3, 5, 8])) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, s string, k int")
    got = {x["id"]: x["rank"] for x in ranking.dense_rank(df, ["s", "k"]).collect()}

    def order(row):
        return (row[1] is not None, row[1] or "", row[2] is not None, row[2] or 0)
    keys = sorted({order(x) for x in rows})
    assert got == {x[0]: keys.index(order(x)) + 1 for x in rows}
    assert ranking.dense_rank(df.limit(0), ["s"]).count() == 0


def test_positions_use_no_window_over_the_rows(spark):
    df = spark.range(1000).selectExpr("id * 7 % 1000 AS v")
    out = ranking.positions(df, ["v"])
    assert [(x["v"], x["position"]) for x in out.orderBy("v").collect()] == [(i, i + 1) for i in range(1000)]


def test_fuec_ranks_without_a_window_over_its_keys(spark):
    from bedflow.plans import fuec
    from bedflow.sources.calendar import date_dim, holiday_dim
    from bedflow.sources.fixtures import encounters
    from tests.conftest import SF001
    text = fuec.fuec_forecast(encounters(spark, SF001, P), date_dim(spark, P), holiday_dim(spark, P), P)._jdf \
        .queryExecution().optimizedPlan().toString()
    windows = [line for line in text.split("\n") if "Window [" in line]
    assert windows and not any("service_name" in w or "month" in w.split("windowspecdefinition")[1] for w in windows)


# --- sweep ---------------------------------------------------------------------------

STAYS = "k string, admit_date date, beddeddays int"


@pytest.mark.parametrize("block_days", [1, 3, 64])
def test_census_by_sweep_equals_listing_every_day(spark, block_days):
    r, start = random.Random(block_days), dt.date(1969, 12, 20)
    rows = [(r.choice(["a", "b", None]), start + dt.timedelta(days=r.randrange(90)), r.choice([0, 1, 2, 7, 40, None]))
            for _ in range(60)] + [("gap", start, 1), ("gap", start + dt.timedelta(days=200), 1), ("a", None, 3)]
    got = {(x["k"], x["day"]): x["census"] for x in sweep.census(
        spark.createDataFrame(rows, STAYS), ["k"], block_days=block_days).collect()}
    counts, spans = {}, {}
    for k, first, length in rows:
        if first and length:
            for i in range(length):
                counts[(k, first + dt.timedelta(days=i))] = counts.get((k, first + dt.timedelta(days=i)), 0) + 1
            low, high = spans.get(k, (first, first))
            spans[k] = (min(low, first), max(high, first + dt.timedelta(days=length - 1)))
    want = {(k, low + dt.timedelta(days=i)): counts.get((k, low + dt.timedelta(days=i)), 0)
            for k, (low, high) in spans.items() for i in range((high - low).days + 1)}
    assert got == want


def test_sweep_spreads_no_stay_over_its_days(spark):
    stays = spark.createDataFrame([("a", dt.date(2000, 1, 1), 3)], STAYS)
    text = plan(sweep.census(stays, ["k"]))
    for line in text.split("\n"):
        if "Generate" in line:
            assert "beddeddays" not in line and "admit_date" not in line
    assert "Generate" not in plan(sweep.events(stays, ["k"]))
    assert sweep.census(stays, []).count() == 3 and sweep.census(stays.limit(0), ["k"]).count() == 0


# --- rolling evaluation ---------------------------------------------------------------

def brute(rows, origins, horizon):
    """{(as_of, model, cohort, f, h): (patients, rate, stayed)} patient by patient."""
    out = {}
    for o in origins:
        gone = [(s, los) for s, c, a, los in rows if a and s and los and a + dt.timedelta(days=los) < o]
        for s, c, a, los in rows:
            if not (a and s and c and los and a < o <= a + dt.timedelta(days=los)):
                continue
            model, cohort = ("ED(C)", evaluation.POOLED) if c == "Emergency" else ("CP(C)", s)
            pool = [x for t, x in gone if cohort == evaluation.POOLED or t == s]
            f = (o - a).days
            now = sum(x >= f for x in pool)
            if not now:
                continue
            for h in range(horizon):
                key = (o, model, cohort, f, h)
                n, _, stayed = out.get(key, (0, 0, 0))
                out[key] = (n + 1, sum(x >= f + 1 + h for x in pool) / now, stayed + (los >= f + 1 + h))
    return out


@pytest.fixture(scope="module")
def history(spark):
    r, start = random.Random(11), dt.date(1999, 1, 1)
    rows = [(r.choice(["A", "B", "C", None]), r.choice(["Emergency", "Inpatient", None]),
             start + dt.timedelta(days=r.randrange(120)), r.choice([0, 1, 2, 3, 5, 9, 14, 30, None])) for _ in range(500)]
    rows.append(("A", "Inpatient", None, 4))
    df = spark.createDataFrame([(str(i), *x) for i, x in enumerate(rows)],
                               "stay_key string, service_code string, care_class string, admit_date date, beddeddays int")
    return rows, df, [start + dt.timedelta(days=d) for d in (0, 30, 31, 60, 119, 400)]


def test_forecast_cells_equal_patient_by_patient(history):
    rows, df, origins = history
    got = {(x["as_of"], x["model_name"], x["cohort"], x["days_stayed"], x["horizon_day"]):
           (x["patients"], x["stay_rate"], x["stayed"]) for x in evaluation.forecast_cells(df, origins, 12).collect()}
    assert got == brute(rows, origins, 12) and len(got) > 500


def test_accuracy_calibration_and_brier_add_up(spark, history):
    rows, df, origins = history
    cells, want = evaluation.forecast_cells(df, origins, 5), brier_of(brute(rows, origins, 5))
    for x in evaluation.brier(cells).collect():
        assert x["brier"] == pytest.approx(want[x["model_name"]], abs=1e-8)
        assert x["brier"] == pytest.approx(x["reliability"] - x["resolution"] + x["uncertainty"] + x["within_bins"], abs=1e-8)
    bins = evaluation.calibration(cells).collect()
    assert sum(x["n"] for x in bins) == sum(n for n, _, _ in brute(rows, origins, 5).values())
    assert all(1 <= x["bin"] <= 10 and abs(x["mean_rate"] - x["observed"] - x["gap"]) < 1e-8 for x in bins)
    weights = spark.createDataFrame([(origins[1], 0.5)], "as_of date, ed_reclassification_rate double")
    plain, weighed = evaluation.forecast_errors(cells), evaluation.forecast_errors(cells, weights)
    a = {(x["model_name"], x["as_of"], x["horizon_day"]): x for x in plain.collect()}
    b = {(x["model_name"], x["as_of"], x["horizon_day"]): x for x in weighed.collect()}
    for key, x in b.items():
        if key[0] == "CP(C)":
            assert x["predicted"] == pytest.approx(a[key]["predicted"])
        elif key[1] == origins[1]:
            assert x["predicted"] == pytest.approx(a[key]["predicted"] / 2)
        else:
            assert x["predicted"] is None
    total = {x["model_name"]: x for x in evaluation.accuracy(plain).where("horizon_day = -1").collect()}
    errors = [x["error"] for k, x in a.items() if k[0] == "CP(C)"]
    assert total["CP(C)"]["n"] == len(errors)
    assert total["CP(C)"]["mae"] == pytest.approx(sum(map(abs, errors)) / len(errors), abs=1e-6)
    assert total["CP(C)"]["rmse"] >= total["CP(C)"]["mae"] >= abs(total["CP(C)"]["bias"])


def brier_of(cells):
    sums = {}
    for (_, model, _, _, _), (n, p, y) in cells.items():
        b, k = sums.get(model, (0, 0))
        sums[model] = (b + y * (1 - p) ** 2 + (n - y) * p * p, k + n)
    return {m: b / k for m, (b, k) in sums.items()}


def test_evaluation_scans_the_stays_twice_at_most(history):
    """One scan for the history of all origins, one for the patients; none per origin."""
    _, df, origins = history
    text = evaluation.forecast_cells(df, origins, 12)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text
    assert evaluation.forecast_cells(df.limit(0), origins, 3).count() == 0


def test_report_has_averages(spark, make_encounters):
    from bedflow.operators.classify import classification_report
    pred = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (3.0, 2.0)], "label double, prediction double")
    got = {r["class"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in classification_report(pred).collect()}
    assert got["macro avg"] == pytest.approx((4 / 9, 0.5, (2 / 3 + 0.5) / 3, 4), abs=1e-8)
    assert got["weighted avg"] == pytest.approx((0.5 + 1 / 12, 0.5, 1 / 3 + 0.125, 4), abs=1e-8)
    assert classification_report(pred.limit(0)).where("class LIKE '% avg'").count() == 0

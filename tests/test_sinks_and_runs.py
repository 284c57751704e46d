"""Sinks, feature publication, the daily run, the landing stream, model
persistence."""
import os

import pytest
from pyspark.sql import functions as F

from bedflow.sources.fixtures import FIXTURE_PARAMS as P
from bedflow.operators import classify
from bedflow.operators.features import los_feature, publish_feature, read_feature
from bedflow.plans.cpc import cpc_model
from bedflow.plans.daily import DailyInputs, run_daily
from bedflow.schemas import COMMON_FORMAT, COMMON_FORMAT_DDL
from bedflow.sources import sinks
from bedflow.sources.calendar import date_dim, holiday_dim
from bedflow.sources.fixtures import cake_snapshot, encounters
from tests.conftest import SF001


@pytest.fixture(scope="module")
def enc(spark):
    return encounters(spark, SF001, P)


def test_conform_casts_by_name(enc):
    out = sinks.conform(cpc_model(enc, P).select(*reversed(cpc_model(enc, P).columns)), COMMON_FORMAT)
    assert out.schema == COMMON_FORMAT or [f.dataType for f in out.schema] == [f.dataType for f in COMMON_FORMAT]
    assert out.columns == [f.name for f in COMMON_FORMAT]
    with pytest.raises(ValueError):
        sinks.conform(enc, COMMON_FORMAT)


def test_create_if_absent_and_append_by_name(spark, enc, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bedflow_t LOCATION '{tmp_path}/db'")
    sinks.create_if_absent(spark, "bedflow_t.cpc_common", COMMON_FORMAT_DDL)
    sinks.create_if_absent(spark, "bedflow_t.cpc_common", COMMON_FORMAT_DDL)  # idempotent
    model = cpc_model(enc, P)
    sinks.append(model.select(*reversed(model.columns)), "bedflow_t.cpc_common", COMMON_FORMAT)
    assert spark.table("bedflow_t.cpc_common").count() == 70


def test_replace_run_is_idempotent(spark, enc, tmp_path):
    path = str(tmp_path / "cpc")
    for _ in range(2):
        sinks.replace_run(cpc_model(enc, P), path, COMMON_FORMAT, {"model": "CP(C)", "as_of": "2000-01-15"})
    sinks.replace_run(cpc_model(enc, P), path, COMMON_FORMAT, {"model": "CP(C)", "as_of": "2000-01-16"})
    back = spark.read.parquet(path)
    assert back.count() == 140
    assert back.where(F.col("as_of") == "2000-01-15").count() == 70


def test_feature_publication(spark, enc, tmp_path):
    root, los = str(tmp_path), los_feature(enc)
    publish_feature(los, root, "t1")
    publish_feature(los, root, "t1")  # the same rows again: nothing changes
    assert read_feature(spark.newSession(), root, "t1").count() == 5
    with pytest.raises(ValueError, match="other rows"):
        publish_feature(los.withColumn("max_bedded_day", F.col("max_bedded_day") + 1), root, "t1")
    with pytest.raises(ValueError, match="not unique"):
        publish_feature(los.unionByName(los), root, "t2")


def test_tables_are_listed_anew(spark, tmp_path):
    from bedflow.sources.tables import read_table
    spark.range(5).write.parquet(str(tmp_path / "region.parquet"))
    assert read_table(spark, str(tmp_path), "region").count() == 5
    spark.range(5).write.mode("append").parquet(str(tmp_path / "region.parquet"))
    assert read_table(spark, str(tmp_path), "region").count() == 10


def test_daily_run(spark, enc, tmp_path):
    inputs = DailyInputs(enc, cake_snapshot(spark, SF001), date_dim(spark, P), holiday_dim(spark, P))
    paths = run_daily(spark, inputs, P, str(tmp_path), feature_version="daily1")
    counts = {k: spark.read.parquet(v).count() for k, v in paths.items()}
    assert counts["cpc"] == 70 and counts["fuec"] == 1376
    assert counts["ensemble"] == counts["cpc"] + counts["edc"]
    assert counts["ed_reclassification_rate"] == 1
    run_daily(spark, inputs, P, str(tmp_path), feature_version="daily1")  # rerun replaces the day
    assert spark.read.parquet(paths["cpc"]).count() == 70


def test_landing_stream(spark, tmp_path):
    from bedflow.streaming.fhir_landing import start_landing_ingest
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.json").write_text(
        '{"resourceType":"Claim","id":"1","item":[{"sequence":1},{"sequence":2}]}\n'
        '{"resourceType":"Patient","id":"p","address":[{"country":"X"}]}\n')
    q = start_landing_ingest(spark, str(landing), str(tmp_path / "out"), name=f"t{os.getpid()}")
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out" / "FHIR_CLAIM_ITEM")).count() == 2
    assert spark.read.parquet(str(tmp_path / "out" / "FHIR_ADDRESS")).count() == 1
    (landing / "b.json").write_text('{"resourceType":"Claim","id":"2","item":[{"sequence":3}]}\n')
    q = start_landing_ingest(spark, str(landing), str(tmp_path / "out"), name=f"t{os.getpid()}")
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out" / "FHIR_CLAIM_ITEM")).count() == 3


def test_classifier_fit_report_and_persist(spark, enc, tmp_path):
    model, test = classify.fit(enc, n_trees=5)
    pred = classify.predictions(model, test)
    report = {r["class"]: r for r in classify.classification_report(pred).collect()}
    assert 0.0 <= report["accuracy"]["precision"] <= 1.0
    assert report["accuracy"]["support"] == test.count()
    classify.save(model, str(tmp_path / "m"))
    again = classify.predictions(classify.load(str(tmp_path / "m")), test)
    assert again.select("prediction").collect() == pred.select("prediction").collect()


def test_classifier_takes_any_stay_length(spark, make_encounters):
    from tests.conftest import enc_row
    rows = [enc_row(i, "1999-03-04", "Past", 120 if i % 2 else 3, service="LONG" if i % 2 else "SHRT")
            for i in range(60)]
    model, test = classify.fit(make_encounters(rows), n_trees=3)
    got = classify.predictions(model, test).collect()
    assert got and all(r.label == r.prediction for r in got) and 120.0 in {r.prediction for r in got}


def test_split_ignores_partitions(enc):
    a, _ = classify.split(classify.classifier_input(enc))
    b, _ = classify.split(classify.classifier_input(enc.repartition(7)))
    assert sorted(a.select("contact_serial_number").collect()) == sorted(b.select("contact_serial_number").collect())


def test_column_estimates(spark):
    from bedflow.operators.monitor import column_distribution, column_estimates
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None), (4, "a")], "x int, s string")
    got = {r.column_name: (r.null_rate, r.approx_distinct) for r in column_estimates(df).collect()}
    assert got == {"x": (0.25, 3), "s": (0.5, 1)}
    rows = {(r.column_name, r.bucket): (r.n, r.share) for r in column_distribution(df, ["s"], ["x"], 3).collect()}
    assert rows == {("s", "a"): (2, 0.5), ("s", "NULL"): (2, 0.5), ("x", "1"): (1, 0.25), ("x", "2"): (1, 0.25),
                    ("x", "3"): (1, 0.25), ("x", "NULL"): (1, 0.25)}
    empty = column_distribution(df.limit(0), ["s"], ["x"])
    assert empty.count() == 0

"""Mergeable daily sketches, and forests scored from their table of nodes."""
import datetime as dt

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from bedflow.operators import forest_table, sketches
from bedflow.sources import published

DAY = dt.date(2000, 1, 31)


def _rows(spark, n=20_000, days=40):
    return spark.range(n).select(
        F.date_add(F.lit(DAY), (F.col("id") % days).cast("int")).alias("day"),
        (F.col("id") * 7919 % 6007).alias("value"),
        F.when(F.col("id") % 10 != 0, F.concat(F.lit("k"), F.col("id") % 97)).alias("name"))


def test_merged_days_estimate_any_range(spark, tmp_path):
    rows, root = _rows(spark), str(tmp_path / "s")
    daily = sketches.daily_sketches(rows, "day", ["name"], ["value"])
    sketches.keep_days(spark, root, daily.where(F.col("day") < F.lit(dt.date(2000, 2, 20))))
    sketches.keep_days(spark, root, daily.where(F.col("day") >= F.lit(dt.date(2000, 2, 10))))  # ten days twice
    for first, last in ((None, None), (dt.date(2000, 2, 5), dt.date(2000, 2, 15)), (DAY, DAY)):
        asked = sketches.estimates(sketches.merged(sketches.stored_days(spark, root, first, last)))
        got = {r["column_name"]: r for r in asked.collect()}
        part = rows.where((F.col("day") >= F.lit(first or DAY)) & (F.col("day") <= F.lit(last or dt.date(2100, 1, 1))))
        n, names, values = part.agg(F.count(F.lit(1)), F.count_distinct("name"), F.count_distinct("value")).first()
        assert got["name"]["n_rows"] == got["value"]["n_rows"] == n
        assert got["name"]["n_nulls"] == part.where("name is null").count() and got["name"]["p50"] is None
        for c, exact in (("name", names), ("value", values)):
            assert abs(got[c]["approx_distinct"] - exact) <= sketches.distinct_error() * exact + 1
        for q, column in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75")):
            below = part.where(F.col("value") < got["value"][column]).count()
            upto = part.where(F.col("value") <= got["value"][column]).count()
            assert below <= (q + sketches.rank_error()) * n and upto >= (q - sketches.rank_error()) * n


def test_corrected_day_replaces_the_old_one_and_other_months_keep_their_files(spark, tmp_path):
    rows, root = _rows(spark, 400), str(tmp_path / "s")
    sketches.keep_days(spark, root, sketches.daily_sketches(rows, "day", ["name"], ["value"]))
    before = published.manifest(spark, root)
    day = dt.date(2000, 2, 3)
    fixed = rows.where(F.col("day") == F.lit(day)).limit(3)
    sketches.keep_days(spark, root, sketches.daily_sketches(fixed, "day", ["name"], ["value"]))
    after = published.manifest(spark, root)
    assert {p for p in before.parts if before.parts[p] != after.parts[p]} == {"2000-02"}
    got = {r["day"]: r["n_rows"] for r in sketches.stored_days(spark, root).where("column_name = 'value'").collect()}
    assert got.pop(day) == 3 and set(got.values()) == {10} and len(got) == 39


def test_a_range_opens_its_months_only(spark, tmp_path):
    root = str(tmp_path / "s")
    sketches.keep_days(spark, root, sketches.daily_sketches(_rows(spark, 400), "day", ["name"], ["value"]))
    asked = sketches.stored_days(spark, root, dt.date(2000, 2, 1), dt.date(2000, 2, 9))
    found = published.manifest(spark, root)
    assert len(found.parts) == 3  # January, February, March
    assert all(found.parts["2000-02"] in f for f in asked.inputFiles())


def test_no_rows_no_days_and_all_null_numbers(spark, tmp_path):
    root = str(tmp_path / "s")
    assert sketches.stored_days(spark, root).count() == 0
    empty = _rows(spark).limit(0)
    sketches.keep_days(spark, root, sketches.daily_sketches(empty, "day", ["name"], ["value"]))
    assert published.manifest(spark, root) is None
    nulls = _rows(spark, 5, 1).withColumn("value", F.lit(None).cast("double"))
    sketches.keep_days(spark, root, sketches.daily_sketches(nulls, "day", [], ["value"]))
    row = sketches.estimates(sketches.merged(sketches.stored_days(spark, root))).first()
    assert (row["n_rows"], row["n_nulls"], row["approx_distinct"], row["p50"]) == (5, 5, 0, None)


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    """A forest over a category and two numbers; the category keeps its splits by values."""
    rows = spark.range(3000).select(
        (F.col("id") * 31 % 17).cast("double").alias("x"), (F.col("id") * 13 % 101).cast("double").alias("y"),
        F.concat(F.lit("c"), F.col("id") * 7 % 5).alias("c"))
    rows = rows.withColumn("cls", ((F.col("x") > 8).cast("int") + (F.col("y") > 50).cast("int")
                                   + F.col("c").isin("c1", "c3").cast("int")).cast("double"))
    stages = [StringIndexer(inputCol="c", outputCol="ci", handleInvalid="keep"),
              VectorAssembler(inputCols=["x", "y", "ci"], outputCol="features", handleInvalid="keep"),
              RandomForestClassifier(labelCol="cls", numTrees=12, maxDepth=4, seed=1, predictionCol="by_model")]
    model = Pipeline(stages=stages).fit(rows)
    path = str(tmp_path_factory.mktemp("forest") / "m")
    model.write().overwrite().save(path)
    return model, path, rows


def test_node_table_scores_equal_the_model_row_by_row(spark, fitted):
    model, path, rows = fitted
    nodes = forest_table.node_table(spark, path)
    assert nodes.where("categories is not null").count() and nodes.where("threshold is not null").count()
    odd = spark.createDataFrame([(float("nan"), 1.0, "c1"), (-1e300, float("inf"), "unseen"), (3.0, 50.0, "c3")], "x double, y double, c string")
    test = rows.drop("cls").unionByName(odd)
    from pyspark.ml.functions import vector_to_array
    scored = forest_table.score(forest_table.prepared(model, test), nodes).withColumn("k", F.struct("x", "y", "c"))
    whole = model.transform(test).select(F.struct("x", "y", "c").alias("k"), "by_model",
                                         vector_to_array("rawPrediction").alias("raw"))
    both = scored.select("k", "votes", "prediction").distinct().join(whole.distinct(), "k")
    assert both.count() == test.distinct().count()
    assert both.where("prediction <> by_model or votes <> raw").count() == 0


def test_single_leaf_trees_and_no_rows(spark, fitted):
    _, path, rows = fitted
    leaf = spark.createDataFrame([(0, 0, -1, None, None, -1, -1, [0.25, 0.75]), (1, 0, -1, None, None, -1, -1, [0.75, 0.25])],
                                 "tree int, node int, feature int, threshold double, categories array<double>, "
                                 "left_child int, right_child int, shares array<double>")
    assert forest_table.depth(leaf) == 0
    x = spark.createDataFrame([([1.0],)], "features array<double>")
    assert forest_table.score(x, leaf).first()["prediction"] == 0.0  # equal votes: the first class
    assert forest_table.score(x.limit(0), leaf).count() == 0


def test_the_walk_neither_multiplies_rows_nor_runs_python(spark, fitted):
    _, path, rows = fitted
    x = spark.createDataFrame([([1.0, 2.0, 0.0],)], "features array<double>")
    plan = forest_table.score(x, forest_table.node_table(spark, path))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan and "Python" not in plan

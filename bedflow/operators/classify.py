"""Length-of-stay classifier (M3-M7) as one Spark ML pipeline.

Past stays -> categorical features indexed in one pass, assembled,
standard-scaled (fitted on the training split only, as part of the pipeline)
-> random forest of 100 trees.  The LOS is a class *label*: it is indexed like
any category and mapped back after prediction, so any stay length fits.  The
split is a hash of the serial number: the same rows whatever the partitions.
Evaluation is a confusion count ``groupBy(label, prediction)`` and metrics
derived from it, all as DataFrames.  Model and scaler persist together as one
PipelineModel.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bedflow.operators.forest_table import prepared, score
from bedflow.operators.survival import past_stays
from bedflow.sources.sinks import stage

CATEGORICAL = ["admit_type", "care_class", "location", "site_desc", "service_code"]
NUMERIC = ["month", "weekday"]
SEED = 42
TRAIN_PERCENT = 80
N_TREES = 100


def classifier_input(encounters: DataFrame) -> DataFrame:
    """Features that do not leak the label, ``label`` = LOS, and ``in_train``:
    whether the serial number's hash falls into the training percent."""
    bucket = F.conv(F.substring(F.md5("contact_serial_number"), 1, 6), 16, 10).cast("int") % 100
    return past_stays(encounters).select(
        "contact_serial_number", *CATEGORICAL,
        F.month("admit_date").cast("double").alias("month"),
        F.dayofweek("admit_date").cast("double").alias("weekday"),
        F.col("beddeddays").cast("double").alias("label"),
        (bucket < TRAIN_PERCENT).alias("in_train"))


def split(data: DataFrame) -> tuple[DataFrame, DataFrame]:
    return data.where("in_train").drop("in_train"), data.where("not in_train").drop("in_train")


def split_counts(data: DataFrame) -> DataFrame:
    """(label, in_train, n): how the split deals out each class."""
    return data.groupBy("label", "in_train").agg(F.count(F.lit(1)).alias("n"))


def scaler_stats(data: DataFrame) -> DataFrame:
    """(feature, mean, stddev) that the scaler learns from the training rows;
    moments rounded to 9 places."""
    train, _ = split(data)
    stats = train.agg(*[f(c).alias(f"{c}_{n}") for c in NUMERIC for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    return stats.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("feature"), F.round(f"{c}_m", 9).alias("mean"), F.round(f"{c}_s", 9).alias("stddev"))
        for c in NUMERIC])).alias("x")).select("x.*")


def baseline_predictions(data: DataFrame) -> DataFrame:
    """Held-out rows with the commonest training LOS of their service (the
    shorter of equals): what the forest has to beat.  Rows of a service without
    training rows are left out."""
    train, test = split(data)
    counts = train.groupBy("service_code", "label").agg(F.count(F.lit(1)).alias("n"))
    best = Window.partitionBy("service_code").orderBy(F.desc("n"), "label")  # services x LOS values
    top = counts.withColumn("r", F.row_number().over(best)).where("r = 1").select(
        "service_code", F.col("label").alias("prediction"))
    return test.join(top, "service_code").select("contact_serial_number", "label", "prediction")


def los_pipeline(n_trees: int = N_TREES, seed: int = SEED) -> Pipeline:
    names = [*CATEGORICAL, "los"]
    index = StringIndexer(inputCols=names, outputCols=[f"{c}_idx" for c in names], handleInvalid="keep")
    assemble = VectorAssembler(inputCols=[f"{c}_idx" for c in CATEGORICAL] + NUMERIC,
                               outputCol="raw_features")
    # Spark's scaler uses the sample standard deviation.
    scale = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    forest = RandomForestClassifier(featuresCol="features", labelCol="los_idx", predictionCol="los_class",
                                    numTrees=n_trees, seed=seed)
    return Pipeline(stages=[index, assemble, scale, forest])


def _with_los(data: DataFrame) -> DataFrame:
    return data.withColumn("los", F.col("label").cast("int").cast("string"))


def fit(encounters: DataFrame, n_trees: int = N_TREES, seed: int = SEED
        ) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training rows, staged once; return the model and the held-out rows."""
    train, test = split(stage(classifier_input(encounters), "classifier-rows"))
    cores = train.sparkSession.sparkContext.defaultParallelism
    if train.rdd.getNumPartitions() < cores:
        train = train.repartition(cores)  # a small table in few files: each pass uses all cores
    return los_pipeline(n_trees, seed).fit(_with_los(train)), test


def _days(model: PipelineModel) -> Column:
    classes = F.array(*[F.lit(float(x)) for x in model.stages[0].labelsArray[-1]])
    return F.try_element_at(classes, (F.col("los_class") + 1).cast("int")).alias("prediction")


def predictions(model: PipelineModel, test: DataFrame) -> DataFrame:
    """contact_serial_number, label, prediction (both LOS in days)."""
    return model.transform(_with_los(test)).select("contact_serial_number", "label", _days(model))


def table_predictions(model: PipelineModel, nodes: DataFrame, test: DataFrame) -> DataFrame:
    """The same from the forest's node table (``operators.forest_table``); of
    ``model`` only the indexing and scaling are used."""
    rows = prepared(model, _with_los(test))
    return score(rows, nodes, prediction="los_class").select("contact_serial_number", "label", _days(model))


def classification_report(pred: DataFrame) -> DataFrame:
    """Per class: precision, recall, f1, support; plus the rows 'accuracy',
    'macro avg' (mean over the classes) and 'weighted avg' (by support), the
    averages rounded to 9 places."""
    conf = pred.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    support = conf.groupBy(F.col("label").alias("cls")).agg(F.sum("n").alias("support"))
    predicted = conf.groupBy(F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    hits = conf.where(F.col("label") == F.col("prediction")).select(
        F.col("label").alias("cls"), F.col("n").alias("tp"))
    per = (support.join(predicted, "cls", "full").join(hits, "cls", "left")
           .na.fill(0, ["support", "predicted", "tp"]))
    precision = F.try_divide(F.col("tp"), F.col("predicted")).cast("double")
    recall = F.try_divide(F.col("tp"), F.col("support")).cast("double")
    f1 = F.try_divide(2 * precision * recall, precision + recall)
    classes = per.select(F.col("cls").cast("string").alias("class"),
                         F.coalesce(precision, F.lit(0.0)).alias("precision"),
                         F.coalesce(recall, F.lit(0.0)).alias("recall"),
                         F.coalesce(f1, F.lit(0.0)).alias("f1"),
                         F.col("support").cast("long").alias("support"))
    acc = conf.agg((F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
                    / F.sum("n")).alias("a"), F.sum("n").alias("s"))
    accuracy = acc.select(F.lit("accuracy").alias("class"), F.col("a").alias("precision"),
                          F.col("a").alias("recall"), F.col("a").alias("f1"),
                          F.col("s").cast("long").alias("support"))
    total, values = F.sum("support"), ("precision", "recall", "f1")
    means = [classes.agg(F.lit(name).alias("class"), *[(F.round(f(c), 9) + 0.0).alias(c) for c in values],
                         total.cast("long").alias("support")).where("support IS NOT NULL") for name, f in (
        ("macro avg", F.avg), ("weighted avg", lambda c: F.sum(F.col(c) * F.col("support")) / total))]
    return classes.unionByName(accuracy).unionByName(means[0]).unionByName(means[1])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)

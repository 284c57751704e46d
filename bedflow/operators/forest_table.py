"""A fitted forest as a table of nodes, scored by built-in functions (M5, M7).

``node_table`` reads the trees of a saved classifier into rows, one per node,
that can be stored, compared and joined like any table.  ``score`` walks them: the
nodes become one array per tree, and each row of features goes down every tree by
higher-order functions, so rows are neither multiplied by the trees nor handed to
Python, and scoring needs neither the model nor the ML library.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Feature number of a leaf.
LEAF = -1


def node_table(spark: SparkSession, path: str) -> DataFrame:
    """The nodes of the last stage, a tree ensemble, of the pipeline saved under
    ``path``: tree, node, feature (-1: a leaf), threshold (numbers), categories
    (the values that go left; NULL for numbers), left_child, right_child, and
    ``shares``, the classes' shares of the training rows that ended there."""
    stages = f"{path.rstrip('/')}/stages"
    folder = spark._jvm.org.apache.hadoop.fs.Path(stages)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    # folders are called <number>_<uid>; as many as the pipeline has stages
    last = max((s.getPath().getName() for s in fs.listStatus(folder)), key=lambda name: int(name.split("_")[0]))
    node, split = F.col("nodeData"), F.col("nodeData.split")
    leaf = node["leftChild"] < 0
    continuous = split["numCategories"] < 0
    values = split["leftCategoriesOrThreshold"]
    stats = node["impurityStats"]
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    return spark.read.parquet(f"{stages}/{last}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"),
        F.when(leaf, LEAF).otherwise(split["featureIndex"]).alias("feature"),
        F.when(~leaf & continuous, F.try_element_at(values, F.lit(1))).alias("threshold"),
        F.when(~leaf & ~continuous, values).alias("categories"),
        node["leftChild"].alias("left_child"), node["rightChild"].alias("right_child"),
        F.when(leaf, F.when(total != 0, F.transform(stats, lambda x: x / total))
               .otherwise(F.transform(stats, lambda x: F.lit(0.0)))).alias("shares"))


def trees(nodes: DataFrame) -> DataFrame:
    """One row: ``trees``, per tree the array of its nodes in order of their
    numbers (which have no gaps).  Its size is that of the model."""
    fields = ["node", "feature", "threshold", "categories", "left_child", "right_child", "shares"]
    one = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("nodes"))
    both = F.array_sort(F.collect_list(F.struct("tree", "nodes")))
    return one.agg(F.transform(both, lambda t: t["nodes"]).alias("trees"))


def depth(nodes: DataFrame) -> int:
    """The most steps from a root to a leaf: nodes a level, as many jobs as levels."""
    level, steps = nodes.where("node = 0").select("tree", "left_child", "right_child"), 0
    kids = F.explode(F.array("left_child", "right_child")).alias("node")
    while level.where("left_child >= 0").limit(1).count():
        below = level.where("left_child >= 0").select("tree", kids)
        level, steps = nodes.join(below, ["tree", "node"]).select("tree", "left_child", "right_child"), steps + 1
    return steps


def _leaf(tree: Column, features: Column, steps: int) -> Column:
    """The leaf of one tree where ``features`` end."""
    def step(at: Column, _: Column) -> Column:
        value = F.get(features, at["feature"])
        left = F.when(at["categories"].isNull(), value <= at["threshold"]).otherwise(
            F.array_contains(at["categories"], value))
        # NaN is larger than any threshold, as in the fitted trees
        return F.when(at["feature"] == LEAF, at).when(left, F.get(tree, at["left_child"])).otherwise(
            F.get(tree, at["right_child"]))
    if not steps:
        return F.get(tree, F.lit(0))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.get(tree, F.lit(0)), step)


def score(rows: DataFrame, nodes: DataFrame, features: str = "features", prediction: str = "prediction") -> DataFrame:
    """``rows`` with ``votes`` (per class, summed over the trees in their order,
    each tree giving its leaf's shares) and ``prediction``, the number of the
    class with the most votes (the first of equals).  ``features`` is an array
    of doubles.  The model enters as a one-row scalar subquery."""
    steps, forest, each = depth(nodes), "_forest", "_each"
    while {forest, each} & set(rows.columns):
        forest, each = forest + "_", each + "_"
    leaves = F.transform(F.col(forest), lambda tree: _leaf(tree, F.col(features), steps)["shares"])
    zeros = F.transform(F.get(each, F.lit(0)), lambda x: F.lit(0.0))
    votes = F.aggregate(F.col(each), zeros, lambda acc, x: F.zip_with(acc, x, lambda a, b: a + b))
    best = F.array_position(F.col("votes"), F.array_max("votes")) - 1
    # a column first: a subquery may not stand in a higher-order function itself
    return (rows.withColumn(forest, trees(nodes).scalar()).withColumn(each, leaves).drop(forest)
            .withColumn("votes", votes).drop(each).withColumn(prediction, best.cast("double")))


def prepared(model: PipelineModel, rows: DataFrame, features: str = "features") -> DataFrame:
    """``rows`` with the array that the pipeline's last stage would get."""
    return PipelineModel(model.stages[:-1]).transform(rows).withColumn(features, vector_to_array(features))

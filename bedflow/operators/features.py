"""Length-of-stay feature (max / min / avg LOS of past stays per service)
and its versioned publication as a table in storage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedflow.operators.survival import stay_histogram
from bedflow.sources import published

FEATURE_NAME = "los_ex_fv"
ENTITY_KEY = "service_code"


def los_feature(encounters: DataFrame, hist: DataFrame | None = None) -> DataFrame:
    """From a ``stay_histogram``, the one given or that of ``encounters``."""
    n, los = F.col("patients"), F.col("beddeddays")
    return ((stay_histogram(encounters) if hist is None else hist)
            .groupBy(ENTITY_KEY)
            .agg(F.max(los).alias("max_bedded_day"),
                 F.min(los).alias("min_bedded_day"),
                 (F.sum(los * n).cast("double") / F.sum(n)).alias("avg_bedded_day")))


def feature_path(root: str, name: str = FEATURE_NAME) -> str:
    return f"{root.rstrip('/')}/{name}"


def publish_feature(feature: DataFrame, root: str, version: str | int,
                    name: str = FEATURE_NAME, key: str = ENTITY_KEY) -> str:
    """Publish ``feature`` once as version ``version`` under ``root``; returns
    the folder that holds it.

    A version appears whole and is immutable: publishing equal rows again
    changes nothing, other rows raise, and of two publishers at the same time
    one is first.  A publisher that dies leaves no version.  The entity key
    must be unique.  The checks are small aggregations.
    """
    spark, path = feature.sparkSession, feature_path(root, name)
    if feature.groupBy(key).count().where("count > 1").limit(1).count():
        raise ValueError(f"entity key {key} is not unique in feature {name}")
    if not published.publish_once(feature, path, f"v{version}"):
        old = read_feature(spark, root, version, name).select(*feature.columns)
        if old.exceptAll(feature).limit(1).count() or feature.exceptAll(old).limit(1).count():
            raise ValueError(f"feature {name} version {version} exists with other rows")
    return f"{path}/{published.manifest(spark, path, f'v{version}').parts[published.WHOLE]}"


def read_feature(spark: SparkSession, root: str, version: str | int, name: str = FEATURE_NAME) -> DataFrame:
    return published.read(spark, feature_path(root, name), f"v{version}")

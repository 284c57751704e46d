"""Sinks: cast-to-contract projection, create-if-absent tables, partitioned
append/replace, and the stringified view of the common format (S7-S11)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bedflow.session import shared_dir
from bedflow.sources import published


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's columns *by name*, cast to the declared types.

    Missing columns fail loudly; extra working columns are dropped.  Rates
    are doubles until here: a double cast to DECIMAL(25,20) keeps its ~17
    significant digits and pads the rest.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing contract columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def create_if_absent(spark: SparkSession, table: str, ddl: str,
                     partitioned_by: list[str] | None = None, location: str | None = None) -> None:
    part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet{part}{place}")


def append(df: DataFrame, table: str, schema: T.StructType) -> None:
    """INSERT ... SELECT, but by column name, never by position."""
    conform(df, schema).write.mode("append").saveAsTable(table)


def replace_run(df: DataFrame, path: str, schema: T.StructType,
                partition_cols: dict[str, object]) -> None:
    """Overwrite only this run's partition(s) (dynamic partition overwrite),
    so re-running a day replaces its rows instead of appending duplicates."""
    out = conform(df, schema)
    for name, value in partition_cols.items():
        out = out.withColumn(name, F.lit(value))
    (out.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols)
     .parquet(path))


def replace_table(df: DataFrame, path: str) -> None:
    """``create or replace table`` as a full overwrite of a folder.  Readers find
    no files meanwhile; ``published.replace`` has no such gap."""
    df.write.mode("overwrite").parquet(path)


def publish_run(df: DataFrame, root: str, schema: T.StructType, part: str) -> str:
    """Replaces one run's rows of a published table (its part ``part``) in one
    step; returns the folder that holds them."""
    spark, out = df.sparkSession, conform(df, schema)
    folder = published.write_aside(out, root)[published.WHOLE]
    published.update(spark, root, out.schema, lambda base: ({part: folder}, base.about))
    return f"{root.rstrip('/')}/{folder}"


#: Spark's setting that removes a statement's shuffle files when it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, a write removes its shuffle files once it is committed: nothing
    reads them again, since what follows starts from the table written."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stage(df: DataFrame, label: str, partition_by: list[str] | None = None,
          compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder
    (``spark.checkpoint.dir``) and read it back: later jobs and lost executors
    start from the table, which can be pruned by column and partition.
    ``discard`` deletes it when nothing needs it any more."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    if compression:
        writer = writer.option("compression", compression)
    with shuffles_removed(spark):
        writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that no later job reads: their successors are
    written, so that nothing is computed from them again, lost executors or not."""
    for df in staged:
        path = getattr(df, "staged_at", None)
        if path is not None:
            spark = df.sparkSession
            location = spark._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def common_format_text(model: DataFrame) -> DataFrame:
    """The stringified projection the table-function model serves: test
    constants, timestamps and dates as text."""
    return model.select(
        F.lit("test").alias("model_source"),
        F.lit("test").alias("model_sequence"),
        F.date_format("model_timestamp", "yyyy-MM-dd HH:mm:ss.SSS").alias("model_timestamp"),
        "model_source_data", "model_name", "model_output", "patient_type",
        "patient_timeframe", "patient_strata", "stay_key", "stay_key_seq",
        F.lit("1").alias("num_of_patient"),
        F.lit("1").alias("stay_rate"),
        F.date_format("stay_start_date", "yyyy-MM-dd").alias("stay_start_date"),
        F.date_format("stay_end_date", "yyyy-MM-dd").alias("stay_end_date"),
    )


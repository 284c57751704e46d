"""Readers for the driver's parquet tables, with explicit column lists so the
scan's ReadSchema holds only what the plan uses.  Every read lists the files
anew, so appended data is seen by the next query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df

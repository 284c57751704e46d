"""From raw documents to packed training sequences: language ID, toxicity,
exact dedup, near-dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the
columns of documents; the last returns one row per packed piece.  ``run``
writes every stage to the shared folder and rereads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bedflow.llm import exact_dedup, language_id, packing, simhash, toxicity
from bedflow.llm.common import stage


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified with confidence."""
    return language_id.keep_known_languages(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labels, lets pass."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints, the document with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return packing.pack_documents(docs)


STAGES = [("language_id", keep_known_languages), ("toxicity", drop_toxic), ("exact_dedup", drop_copies),
          ("simhash", drop_near_copies), ("packing", pack)]

#: Trained models and hashing are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

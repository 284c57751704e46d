"""JSON document sources: one JSON text per row (S6).

``fhir_documents`` builds the fixture's bulk export from the driver tables:
Claim (orders + their lineitems), Patient (customer + nation + region) and
Encounter (orders).  ``parse_documents`` turns any text column into VARIANT.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedflow.sources.tables import read_table

DOC_COL = "file_row"
_JSON_OPTS = {"ignoreNullFields": "false"}

# Fixture mapping of order status to an encounter status.
ENCOUNTER_STATUS = (("F", "finished"), ("O", "in-progress"))
ENCOUNTER_STATUS_OTHER = "planned"


def _money(c: str):
    return F.col(c).cast("decimal(12,2)")


def claim_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])
    # One array per order: the document *is* the order with its lines.
    # collect_list gains nothing from a map-side partial aggregate, so the
    # lines are hash-partitioned by order first and grouped in parallel.
    items = (li.repartition("l_orderkey").groupBy("l_orderkey")
             .agg(F.array_sort(F.collect_list(F.struct(
                 F.col("l_linenumber").alias("sequence"),
                 _money("l_quantity").alias("quantity"),
                 _money("l_extendedprice").alias("net")))).alias("item")))
    doc = F.struct(
        F.lit("Claim").alias("resourceType"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("status"),
        _money("o_totalprice").alias("total"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("created"),
        F.coalesce(F.col("item"), F.array().cast(items.schema["item"].dataType)).alias("item"))
    return (orders.join(items, orders.o_orderkey == items.l_orderkey, "left")
            .select(F.to_json(doc, _JSON_OPTS).alias(DOC_COL)))


def patient_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal"])
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)  # 25 x 5 rows
    doc = F.struct(
        F.lit("Patient").alias("resourceType"),
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") >= 0).alias("active"),
        _money("c_acctbal").alias("balance"),
        F.array(F.struct(F.col("n_name").alias("country"), F.col("r_name").alias("region")))
        .alias("address"))
    return (cust.join(F.broadcast(geo), cust.c_nationkey == geo.n_nationkey, "left")
            .select(F.to_json(doc, _JSON_OPTS).alias(DOC_COL)))


def encounter_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    status = F.lit(ENCOUNTER_STATUS_OTHER)
    for code, name in reversed(ENCOUNTER_STATUS):
        status = F.when(F.col("o_orderstatus") == code, F.lit(name)).otherwise(status)
    doc = F.struct(
        F.lit("Encounter").alias("resourceType"),
        F.col("o_orderkey").cast("string").alias("id"),
        status.alias("status"),
        F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("start")).alias("period"),
        F.array(F.struct(F.col("o_orderpriority").alias("role"))).alias("participant"))
    return orders.select(F.to_json(doc, _JSON_OPTS).alias(DOC_COL))


def fhir_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bulk export: one JSON text per row in column ``file_row``."""
    return (claim_documents(spark, sf_dir)
            .unionByName(patient_documents(spark, sf_dir))
            .unionByName(encounter_documents(spark, sf_dir)))


#: Builders of the export, by the resource they write.
RESOURCE_DOCUMENTS = {"Claim": claim_documents, "Patient": patient_documents, "Encounter": encounter_documents}


def messy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export as it comes: claims whose item is now an array, now an object,
    now absent, extensions with a property called ``value``, elements of mixed
    kinds, missing ids, and text that is no document."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    k, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    doc = F.concat(
        F.lit('{"resourceType":"Claim"'),
        F.when(k % 5 != 0, F.concat(F.lit(',"id":"'), text, F.lit('"'))).otherwise(""),
        F.when(k % 3 == 0, F.concat(F.lit(',"item":[{"sequence":"1","value":"'), F.col("o_orderstatus"),
                                    F.lit('"},{"sequence":"2"},'), text, F.lit("]")))
        .when(k % 3 == 1, F.concat(F.lit(',"item":{"sequence":"'), text, F.lit('"}'))).otherwise(""),
        F.lit("}"))
    bad = F.when(k % 10 == 7, F.substring(doc, 1, 20)).when(k % 10 == 8, F.concat(F.lit('{"id":"'), text, F.lit('"}')))
    return orders.select(F.coalesce(bad, doc).alias(DOC_COL))


def spelling_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_row, batch): claims under three spellings of the resource, with
    ``Status`` beside ``status``, a property called like the batch column, and a
    number that is text in the second batch."""
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"])
    k, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    name = F.when(k % 3 == 0, "Claim").when(k % 3 == 1, "CLAIM").otherwise("claim")
    doc = F.concat(
        F.lit('{"resourceType":"'), name, F.lit('","id":"'), text, F.lit('","'),
        F.when(k % 4 == 0, "Status").otherwise("status"), F.lit('":"'), F.col("o_orderstatus"),
        F.when(k % 8 == 0, F.concat(F.lit('","status":"'), F.col("o_orderstatus"))).otherwise(""),
        F.lit('","ingest_batch":"export-'), (k % 5).cast("string"), F.lit('","seq":'),
        F.when(k % 2 == 1, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text), F.lit("}"))
    return orders.select(doc.alias(DOC_COL), (k % 2).cast("int").alias("batch"))


def parse_documents(docs: DataFrame, col: str = DOC_COL) -> DataFrame:
    """(file_row, doc VARIANT, resource_type); malformed text gives NULL doc.
    Documents are parsed where their input split is read."""
    v = F.try_parse_json(F.col(col))
    return (docs.select(F.col(col), v.alias("doc"))
            .withColumn("resource_type", F.try_variant_get("doc", "$.resourceType", "string")))


def rejects(parsed: DataFrame, col: str = DOC_COL) -> DataFrame:
    """(text, reason) of documents that are not JSON objects with a resourceType."""
    bad = parsed.where(F.col(col).isNotNull() & (F.col("doc").isNull() | F.col("resource_type").isNull()))
    return bad.select(F.col(col), F.when(F.col("doc").isNull(), "not JSON").otherwise("no resourceType").alias("reason"))

"""Logical model inputs derived from the driver tables (FIXTURES.md).

Each function is a lazy view over the parquet tables; the DuckDB oracle
builds the same rows with the same arithmetic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedflow.config import CURRENT, PAST, SNAPSHOT_MODEL_NAME, Params
from bedflow.functions.dates import lit_ts_ntz
from bedflow.sources.calendar import holiday_dim
from bedflow.sources.tables import read_table

# The site of the fixture, and the run that the queries make of it.
KEPT_LOCATION = "PACU Mandell"
MODEL_SOURCE_DATA = "CONS_PROD"
FIXTURE_PARAMS = Params(
    as_of=dt.date(2000, 1, 15), run_ts=dt.datetime(2000, 1, 15, 4, 0, 0),
    uplift_before=dt.date(1999, 7, 1), snapshots_from=dt.date(1995, 1, 1),
    calendar_start=dt.date(1995, 1, 1), calendar_end=dt.date(2002, 12, 31),
    kept_location=KEPT_LOCATION, model_source_data=MODEL_SOURCE_DATA)
#: The same orders this many days later: a run far outside the first calendar.
LATER_DAYS = 9497
LATER_PARAMS = FIXTURE_PARAMS.with_(
    as_of=dt.date(2026, 1, 15), run_ts=dt.datetime(2026, 1, 15, 4, 0, 0),
    uplift_before=dt.date(2025, 7, 1), snapshots_from=dt.date(2021, 1, 1),
    calendar_start=dt.date(2021, 1, 1), calendar_end=dt.date(2028, 12, 31))

# Fixture mappings from driver columns to encounter attributes.
CURRENT_WINDOW_DAYS = 21
PAST_LOS_MODULUS = 15
URGENT_PRIORITIES = ("1-URGENT", "4-NOT SPECIFIED")
EMERGENCY_PRIORITY = "2-HIGH"
CARE_CLASS_BY_KEY_MOD4 = ("Emergency", "Inpatient", "Observation", "Surgery Admit")
MAIN_SITE_MAX_REGION = 3


def encounters(spark: SparkSession, sf_dir: str, p: Params, later_days: int = 0) -> DataFrame:
    """One row per order before ``as_of``: the encounter table.  ``later_days``
    moves all order dates."""
    orders = read_table(spark, sf_dir, "orders",
                        ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]
                        ).where(F.col("o_orderdate") < lit_ts_ntz(p.as_of - dt.timedelta(days=later_days)))
    if later_days:
        orders = orders.withColumn("o_orderdate", F.expr(f"timestampadd(DAY, {later_days}, o_orderdate)"))
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    # nation is a fixed 25-row dimension: a proven broadcast.
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    cust = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
    # Holidays: three per calendar year, bounded by the calendar.
    hol = holiday_dim(spark, p).select(F.col("date").alias("hol_date"))

    as_of = f"DATE'{p.as_of.isoformat()}'"
    current = f"to_date(o_orderdate) >= {as_of} - {CURRENT_WINDOW_DAYS}"
    urgent = ", ".join(f"'{x}'" for x in URGENT_PRIORITIES)
    care = ", ".join(f"'{x}'" for x in CARE_CLASS_BY_KEY_MOD4)
    joined = (orders.join(cust, orders.o_custkey == cust.c_custkey)
              .join(F.broadcast(hol), F.to_date("o_orderdate") == hol.hol_date, "left"))
    return joined.selectExpr(
        "CAST(o_orderkey AS STRING) AS contact_serial_number",
        "to_date(o_orderdate) AS admit_date",
        "timestampadd(HOUR, o_orderkey % 24, o_orderdate) AS admit_dttm",
        f"IF({current}, '{CURRENT}', '{PAST}') AS patient_type",
        f"IF({current}, datediff({as_of}, to_date(o_orderdate)), "
        f"CAST((7 * o_orderkey + 3 * o_custkey) % {PAST_LOS_MODULUS} AS INT)) AS beddeddays",
        "substring(c_mktsegment, 1, 4) AS service_code",
        "c_mktsegment AS service_name",
        f"CASE WHEN o_orderpriority IN ({urgent}) THEN 'Urgent' "
        f"WHEN o_orderpriority = '{EMERGENCY_PRIORITY}' THEN 'Emergency' ELSE 'Elective' END AS admit_type",
        f"element_at(array({care}), CAST(o_orderkey % 4 + 1 AS INT)) AS care_class",
        f"CASE WHEN o_orderkey % 10 = 0 THEN '{p.kept_location}' WHEN o_orderkey % 10 <= 4 THEN 'Ward A' "
        "ELSE 'Ward B' END AS location",
        f"IF(n_regionkey < {MAIN_SITE_MAX_REGION}, 'Main', 'Satellite') AS site_desc",
        "IF(hol_date IS NOT NULL, 'Y', 'N') AS observed_holiday_ind",
    )


def cake_snapshot(spark: SparkSession, sf_dir: str, later_days: int = 0) -> DataFrame:
    """Daily model snapshots: several rows per stay (lineitem x orders)."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    admit_date = F.date_add(F.to_date("o_orderdate"), later_days)
    return li.join(orders, li.l_orderkey == orders.o_orderkey).select(
        F.col("o_orderkey").cast("string").alias("stay_key"),
        admit_date.alias("admit_date"),
        F.date_add(admit_date, F.col("l_linenumber")).alias("snapshot_date"),
        F.lit(SNAPSHOT_MODEL_NAME).alias("orig_model_name"),
        F.when(F.col("l_returnflag") == "A", F.lit("ED Admit"))
        .otherwise(F.lit("Transfer")).alias("category_desc"),
        F.when(F.col("l_linestatus") == "F", F.lit(-1)).otherwise(F.lit(0)).alias("stay_date_offset"),
    )

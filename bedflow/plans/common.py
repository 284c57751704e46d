"""Projection onto the 15-column common model format (S10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedflow.config import MODEL_OUTPUT, PATIENT_STRATA, SIMULATED_PATIENT_TYPE, Params
from bedflow.functions.dates import lit_ts_ntz


def common_format(rows: DataFrame, p: Params, model_name: str,
                  num_of_patient: Column) -> DataFrame:
    """rows: stay_key, patient_timeframe, stay_key_seq, stay_rate, start, end.

    Working types (string / long / timestamp_ntz / int / double / date);
    ``sources.sinks.conform`` casts to the declared decimals at the sink.
    """
    return rows.select(
        F.lit(p.model_source).alias("model_source"),
        F.lit(p.model_sequence).cast("long").alias("model_sequence"),
        lit_ts_ntz(p.run_ts).alias("model_timestamp"),
        F.lit(p.model_source_data).alias("model_source_data"),
        F.lit(model_name).alias("model_name"),
        F.lit(MODEL_OUTPUT).alias("model_output"),
        F.lit(SIMULATED_PATIENT_TYPE).alias("patient_type"),
        F.col("patient_timeframe"),
        F.lit(PATIENT_STRATA).alias("patient_strata"),
        F.col("stay_key"),
        F.col("stay_key_seq").cast("int").alias("stay_key_seq"),
        num_of_patient.cast("double").alias("num_of_patient"),
        F.col("stay_rate").cast("double").alias("stay_rate"),
        F.col("stay_start_date"),
        F.col("stay_end_date"),
    )

"""Output contracts (the common model format and the FUEC format).

Models compute in double / int / string; ``sources.sinks.conform`` casts to
these types only at the sink.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The columns, types and text lengths that consumers of the two
# formats rely on.
def _text(name: str, length: int) -> T.StructField:
    return T.StructField(name, T.StringType(), metadata={"length": length})


COMMON_FORMAT = T.StructType([
    _text("model_source", 10),
    T.StructField("model_sequence", T.DecimalType(38, 0)),
    T.StructField("model_timestamp", T.TimestampNTZType()),
    _text("model_source_data", 50),
    _text("model_name", 50),
    _text("model_output", 25),
    _text("patient_type", 25),
    _text("patient_timeframe", 12),
    _text("patient_strata", 50),
    _text("stay_key", 50),
    T.StructField("stay_key_seq", T.DecimalType(10, 0)),
    T.StructField("num_of_patient", T.DecimalType(25, 20)),
    T.StructField("stay_rate", T.DecimalType(25, 20)),
    T.StructField("stay_start_date", T.DateType()),
    T.StructField("stay_end_date", T.DateType()),
])

FUEC_FORMAT = T.StructType([
    T.StructField("day", T.DateType()),
    T.StructField("dayofweek", T.DecimalType(1, 0)),
    _text("day_of_week", 10),
    T.StructField("month", T.DecimalType(2, 0)),
    _text("service_name", 40),
    _text("service_code", 4),
    T.StructField("patients", T.DecimalType(25, 20)),
    T.StructField("beddeddays", T.DecimalType(5, 0)),
    T.StructField("stay_rate", T.DecimalType(22, 20)),
    _text("admit_type", 30),
    _text("location", 20),
    _text("site_desc", 30),
    _text("stay_key", 50),
    T.StructField("stay_key_seq", T.DecimalType(10, 0)),
    T.StructField("expected_los", T.DecimalType(24, 20)),
    T.StructField("update_dttm", T.TimestampNTZType()),
])

def ddl(schema: T.StructType) -> str:
    """Column list of a CREATE TABLE with the contract's types and lengths."""
    return ", ".join(f"{f.name} " + (f"VARCHAR({f.metadata['length']})" if "length" in f.metadata
                                     else f.dataType.simpleString().upper()) for f in schema.fields)


COMMON_FORMAT_DDL = ddl(COMMON_FORMAT)
FUEC_FORMAT_DDL = ddl(FUEC_FORMAT)
COMMON_COLUMNS = [f.name for f in COMMON_FORMAT.fields]
FUEC_COLUMNS = [f.name for f in FUEC_FORMAT.fields]

# Logical inputs (the columns the models touch).
ENCOUNTERS = T.StructType([
    T.StructField("contact_serial_number", T.StringType()),
    T.StructField("admit_date", T.DateType()),
    T.StructField("admit_dttm", T.TimestampNTZType()),
    T.StructField("patient_type", T.StringType()),
    T.StructField("beddeddays", T.IntegerType()),
    T.StructField("service_code", T.StringType()),
    T.StructField("service_name", T.StringType()),
    T.StructField("admit_type", T.StringType()),
    T.StructField("care_class", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("site_desc", T.StringType()),
    T.StructField("observed_holiday_ind", T.StringType()),
])

CAKE_SNAPSHOT = T.StructType([
    T.StructField("stay_key", T.StringType()),
    T.StructField("admit_date", T.DateType()),
    T.StructField("snapshot_date", T.DateType()),
    T.StructField("orig_model_name", T.StringType()),
    T.StructField("category_desc", T.StringType()),
    T.StructField("stay_date_offset", T.IntegerType()),
])

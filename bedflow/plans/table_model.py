"""Table-function model (M2): a DataFrame-in, DataFrame-out model whose body
is plain pandas, applied batch by batch with ``mapInPandas`` (Arrow
batches, no per-row Python).  The body is the stringified common format
(S11); unlike the original, it reads the rows it is given.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from bedflow.schemas import COMMON_COLUMNS

OUTPUT_SCHEMA = ", ".join(
    f"{c} {'int' if c == 'stay_key_seq' else 'string'}" for c in COMMON_COLUMNS)


def predict(batch: pd.DataFrame) -> pd.DataFrame:
    out = pd.DataFrame(index=batch.index)
    out["model_source"] = "test"
    out["model_sequence"] = "test"
    ts = pd.to_datetime(batch["model_timestamp"])
    out["model_timestamp"] = ts.dt.strftime("%Y-%m-%d %H:%M:%S.%f").str.slice(0, 23)
    for c in ["model_source_data", "model_name", "model_output", "patient_type",
              "patient_timeframe", "patient_strata", "stay_key", "stay_key_seq"]:
        out[c] = batch[c]
    out["num_of_patient"] = "1"
    out["stay_rate"] = "1"
    for c in ["stay_start_date", "stay_end_date"]:
        out[c] = pd.to_datetime(batch[c]).dt.strftime("%Y-%m-%d")
    return out


def table_model(model_output: DataFrame, model: Callable[[pd.DataFrame], pd.DataFrame] = predict,
                schema: str = OUTPUT_SCHEMA) -> DataFrame:
    """Apply ``model``, any function of a pandas frame, batch by batch.  The
    default body could as well be built-ins (``sinks.common_format_text``)."""
    def batches(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in it:
            yield model(batch)
    return model_output.select(*COMMON_COLUMNS).mapInPandas(batches, schema)


SAMPLE_ORDER = ["stay_key", "stay_key_seq", "stay_start_date"]


def sample_input(model_output: DataFrame, n: int = 5) -> DataFrame:
    """The head sample a table-function model is registered with (L3), in a
    fixed order so it is reproducible; planned as a distributed take-ordered."""
    return model_output.select(*COMMON_COLUMNS).orderBy(*SAMPLE_ORDER).limit(n)

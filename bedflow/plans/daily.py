"""One daily run: LOS feature -> CP(C), ED(C), FUEC -> ensemble.

The order of the original task graph, as plain function calls; scheduling
belongs to whatever runs this (cron, an orchestrator).  Each model is
written once, cast to its contract, as its own (model, as_of) part of a
published table, so a rerun of a day replaces that day in one step instead of
appending duplicates, and readers (``published.read``) see whole runs only.
The ensemble reads the written rows back: it never recomputes the models, and
its lineage starts at storage, so a lost executor costs only the tasks of the
last stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bedflow.config import Params
from bedflow.operators.features import los_feature, publish_feature, read_feature
from bedflow.operators.survival import require_unique, stay_histogram
from bedflow.plans import cpc, edc, fuec
from bedflow.plans.ensemble import ensemble_union
from bedflow.schemas import COMMON_COLUMNS, COMMON_FORMAT, FUEC_FORMAT
from bedflow.sources import published, sinks


@dataclass(frozen=True)
class DailyInputs:
    encounters: DataFrame
    snapshots: DataFrame
    date_dim: DataFrame
    holidays: DataFrame


def _write(df: DataFrame, out_dir: str, table: str, schema, model: str, p: Params) -> str:
    return sinks.publish_run(df, f"{out_dir.rstrip('/')}/{table}", schema, f"{model} {p.as_of.isoformat()}")


def run_daily(spark: SparkSession, inputs: DailyInputs, p: Params, out_dir: str,
              feature_version: str | int | None = None) -> dict[str, str]:
    """Compute and publish every model for ``p.as_of``; returns the folders of
    this run's rows."""
    require_unique(inputs.encounters, "contact_serial_number")
    # one history scan: the feature and both curves come from this histogram
    hist = sinks.stage(stay_histogram(inputs.encounters), "stay-histogram")
    los = None
    if feature_version is not None:
        publish_feature(los_feature(inputs.encounters, hist), out_dir, feature_version)
        los = read_feature(spark, out_dir, feature_version)
    # The one-row reclassification rate replaces its table (S8) and the model
    # reads that fresh value back (N4), not a stale copy.
    rate_root = f"{out_dir.rstrip('/')}/ed_reclassification_rate"
    written = published.replace(edc.ed_reclassification_rate(inputs.snapshots, p), rate_root)
    rate = published.rows_of(spark, rate_root, written)
    paths = {
        "ed_reclassification_rate": f"{rate_root}/{written.parts[published.WHOLE]}",
        "cpc": _write(cpc.cpc_model(inputs.encounters, p.with_(model_source="CPC"), los=los, hist=hist),
                      out_dir, "cpc_model_common_format", COMMON_FORMAT, "CP(C)", p),
        "edc": _write(edc.edc_model(inputs.encounters, p.with_(model_source="EDC"), rate=rate, hist=hist),
                      out_dir, "edc_model_common_format", COMMON_FORMAT, "ED(C)", p),
        "fuec": _write(fuec.fuec_forecast(inputs.encounters, inputs.date_dim, inputs.holidays, p),
                       out_dir, "fuec_model_common_format", FUEC_FORMAT, "FUEC", p),
    }
    models = [spark.read.parquet(paths[m]).select(*COMMON_COLUMNS) for m in ("cpc", "edc")]
    paths["ensemble"] = _write(ensemble_union(*models), out_dir, "ensemble_model_common_format",
                               COMMON_FORMAT, "ENSEMBLE", p)
    return paths

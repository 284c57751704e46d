"""Registered queries: name -> (spark, sf_dir) -> DataFrame over the fixture.

Every query reads the driver tables through the fixture views, so its work
grows with the data.  Names follow the build order of the blueprint.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bedflow.operators.features import los_feature
from bedflow.operators.survival import (conditional_rates, curve_arrays, los_histogram,
                                        past_stays, stay_histogram, survival_curve)
from bedflow.plans import cpc, edc, fuec
from bedflow.schemas import COMMON_COLUMNS, COMMON_FORMAT, COMMON_FORMAT_DDL
from bedflow.sources.calendar import date_dim, holiday_dim
from bedflow.sources.fixtures import FIXTURE_PARAMS as P
from bedflow.sources.fixtures import LATER_DAYS, LATER_PARAMS, cake_snapshot, encounters
from bedflow.sources.sinks import stage

Query = Callable[[SparkSession, str], DataFrame]
EDC_PARAMS = P.with_(model_source="EDC")
# the stays as known when the horizon has passed
CENSUS_PARAMS = P.with_(as_of=dt.date(2000, 5, 15))


def _enc(spark: SparkSession, sf: str) -> DataFrame:
    return encounters(spark, sf, P)


def _cpc_hist(spark: SparkSession, sf: str) -> DataFrame:
    return los_histogram(past_stays(_enc(spark, sf)), cpc.COHORT)


def _cpc_curve(spark: SparkSession, sf: str) -> DataFrame:
    return survival_curve(_cpc_hist(spark, sf), cpc.COHORT)


def q_encounters_view(spark, sf):
    return _enc(spark, sf)


def q_cake_snapshot_view(spark, sf):
    return cake_snapshot(spark, sf)


def q_los_feature(spark, sf):
    return los_feature(_enc(spark, sf))


def q_los_histogram(spark, sf):
    return los_histogram(past_stays(_enc(spark, sf)), cpc.COHORT)


def q_survival_curve(spark, sf):
    return _cpc_curve(spark, sf)


def q_conditional_stay_rate(spark, sf):
    return conditional_rates(curve_arrays(_cpc_hist(spark, sf), cpc.COHORT), cpc.COHORT)


def q_expected_los(spark, sf):
    return curve_arrays(_cpc_hist(spark, sf), cpc.COHORT).select("service_code", "expected_los")


def q_cpc_future(spark, sf):
    return cpc.cpc_future(_enc(spark, sf), P)


def q_cpc_backfill(spark, sf):
    return cpc.cpc_backfill(_enc(spark, sf), P)


def q_cpc_model(spark, sf):
    return cpc.cpc_model(_enc(spark, sf), P)


def _later(spark, sf):
    return encounters(spark, sf, LATER_PARAMS, LATER_DAYS)


def q_cpc_backfill_later(spark, sf):
    """The same orders in another decade: no calendar bounds the model."""
    return cpc.cpc_backfill(_later(spark, sf), LATER_PARAMS)


def q_cpc_model_later(spark, sf):
    return cpc.cpc_model(_later(spark, sf), LATER_PARAMS)


def q_edc_model_later(spark, sf):
    return edc.edc_model(_later(spark, sf), LATER_PARAMS.with_(model_source="EDC"),
                         snapshots=cake_snapshot(spark, sf, LATER_DAYS))


def q_cpc_model_published_feature(spark, sf):
    """With a published feature whose longest stay lies three days beyond the
    history: days without survivors have a NULL rate."""
    e = _enc(spark, sf)
    los = los_feature(e).withColumn("max_bedded_day", F.col("max_bedded_day") + 3)
    return cpc.cpc_model(e, P, los=los)


def q_common_format_text(spark, sf):
    from bedflow.sources.sinks import common_format_text
    return common_format_text(q_cpc_model(spark, sf))


def _working_types(rows):
    """The common format's decimals as the types the models compute in."""
    kinds = {"model_sequence": "long", "stay_key_seq": "int", "num_of_patient": "double", "stay_rate": "double"}
    return rows.select(*[F.col(c).cast(kinds[c]) if c in kinds else F.col(c) for c in COMMON_COLUMNS])


def q_replace_run_readback(spark, sf):
    """The daily run's sink, written twice and read back: one day's rows."""
    from bedflow.session import shared_dir
    from bedflow.sources.sinks import replace_run, replace_table
    path = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    rows = q_cpc_model(spark, sf)
    replace_table(rows, f"{path}/model")
    written = spark.read.parquet(f"{path}/model")
    for _ in range(2):
        replace_run(written, f"{path}/daily", COMMON_FORMAT, {"model": "CP(C)", "as_of": P.as_of.isoformat()})
    return _working_types(spark.read.parquet(f"{path}/daily"))


def q_append_readback(spark, sf):
    """A table created if absent (twice), appended to by column name, read back."""
    from bedflow.session import shared_dir
    from bedflow.sources.sinks import append, create_if_absent
    name = f"bedflow_append_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{name}"
    for _ in range(2):
        create_if_absent(spark, name, COMMON_FORMAT_DDL, location=path)
    rows = q_cpc_model(spark, sf)
    append(rows.select(*reversed(rows.columns)), name, COMMON_FORMAT)
    spark.sql(f"DROP TABLE {name}")  # external: the rows stay at the path
    return _working_types(spark.read.parquet(path))


def q_ed_reclassification_rate(spark, sf):
    return edc.ed_reclassification_rate(cake_snapshot(spark, sf), P)


def q_edc_rates_pooled(spark, sf):
    return edc.edc_rates_pooled(_enc(spark, sf))


def q_edc_model(spark, sf):
    return edc.edc_model(_enc(spark, sf), EDC_PARAMS, snapshots=cake_snapshot(spark, sf))


def q_fuec_service_keys(spark, sf):
    return fuec.fuec_service_keys(_enc(spark, sf), P)


def q_fuec_daily_arrivals(spark, sf):
    return fuec.fuec_daily_arrivals(_enc(spark, sf), P).withColumn(
        "patients", F.col("patients").cast("double"))


def q_fuec_seasonal_mean(spark, sf):
    return fuec.fuec_seasonal_mean(_enc(spark, sf), date_dim(spark, P), holiday_dim(spark, P), P)


def q_fuec_cohort_rates(spark, sf):
    return fuec.fuec_cohort_rates(_enc(spark, sf), P)


def q_fuec_forecast(spark, sf):
    return fuec.fuec_forecast(_enc(spark, sf), date_dim(spark, P), holiday_dim(spark, P), P)


def _cpc_and_edc(spark, sf):
    """Both current-patient models from one staged history histogram."""
    e = _enc(spark, sf)
    hist = stage(stay_histogram(e), "stay-histogram")
    return (cpc.cpc_model(e, P, hist=hist),
            edc.edc_model(e, EDC_PARAMS, snapshots=cake_snapshot(spark, sf), hist=hist))


def q_ensemble_union(spark, sf):
    from bedflow.plans.ensemble import ensemble_union
    return ensemble_union(*_cpc_and_edc(spark, sf))


def q_ensemble_top_k(spark, sf):
    from bedflow.plans.ensemble import ensemble_top_k
    return ensemble_top_k(*_cpc_and_edc(spark, sf), k=10)


# ------------------------------------------- published and kept-up tables ---
def _folder(spark, name):
    from bedflow.session import shared_dir
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def q_published_feature_readback(spark, sf):
    """The LOS feature published twice under one version, read back by name."""
    from bedflow.operators.features import publish_feature, read_feature
    root, feature = _folder(spark, "features"), stage(los_feature(_enc(spark, sf)), "los-feature")
    for _ in range(2):
        publish_feature(feature, root, 1)
    return read_feature(spark, root, 1)


def q_replace_published_readback(spark, sf):
    """A published table replaced by itself and by the model, read by its manifest."""
    from bedflow.sources import published
    root, rows = _folder(spark, "published"), q_cpc_model(spark, sf)
    published.replace(rows.limit(3), root)
    published.replace(published.read(spark, root).unionByName(rows), root)
    published.replace(rows, root)
    return published.read(spark, root)


#: The days after which the histogram of the fixture takes in what has changed.
DELTA_DAYS = (dt.date(1996, 1, 1), dt.date(1999, 1, 1), P.as_of)


def _provisional(rows):
    """Every seventh stay is first entered with a length two days too long."""
    late = F.col("contact_serial_number").cast("long") % 7 == 0
    return rows.withColumn("beddeddays", F.when(late & (F.col("patient_type") == "Past"), F.col("beddeddays") + 2)
                           .otherwise(F.col("beddeddays")))


def _daily_changes(spark, sf, upto, since=None):
    """Changed rows between the table as known on ``since`` and on ``upto``,
    from the stays that can have changed: those admitted since, those that were
    Current then, and (last) the lengths corrected."""
    from bedflow.operators.state import row_changes
    columns = ["contact_serial_number", "admit_date", "patient_type", "service_code", "beddeddays"]
    after = encounters(spark, sf, P.with_(as_of=upto)).select(*columns)
    last = upto == DELTA_DAYS[-1]
    after = after if last else _provisional(after)
    if since is None:
        return row_changes(after.limit(0), after)
    before = _provisional(encounters(spark, sf, P.with_(as_of=since)).select(*columns))
    recent = F.col("admit_date") >= F.date_sub(F.lit(since), 21)
    if last:
        recent = recent | (F.col("contact_serial_number").cast("long") % 7 == 0)
    return row_changes(before.where(recent), after.where(recent))


def _histogram_state(spark, sf):
    """The histogram after three batches of changes, the second delivered twice."""
    from bedflow.operators import state
    root = _folder(spark, "histogram")
    for since, upto in zip((None, *DELTA_DAYS), DELTA_DAYS):
        delta = stage(state.histogram_delta(_daily_changes(spark, sf, upto, since)), "histogram-delta")
        for _ in range(2 if upto == DELTA_DAYS[1] else 1):
            state.apply_histogram(spark, root, delta, upto.isoformat())
    return state.histogram(spark, root)


def q_los_histogram_incremental(spark, sf):
    """The histogram kept by changes: stays turning Past, new ones, lengths corrected."""
    return _histogram_state(spark, sf).where("service_code IS NOT NULL")


def q_cpc_model_incremental(spark, sf):
    """CP(C) with curves from the kept histogram: the history is not read."""
    return cpc.cpc_model(_enc(spark, sf), P, hist=_histogram_state(spark, sf))


def _first_seen_state(spark, sf):
    from bedflow.operators import state
    root, all_days = _folder(spark, "first-seen"), cake_snapshot(spark, sf)
    ends = [dt.date(1990, 1, 1), dt.date(1999, 12, 20), dt.date(2000, 1, 8), P.as_of, dt.date(2100, 1, 1)]
    # out of order: the newest days come before older ones
    for i in (0, 2, 1, 3, 2):
        days = (F.col("snapshot_date") >= F.lit(ends[i])) & (F.col("snapshot_date") < F.lit(ends[i + 1]))
        state.merge_snapshots(spark, root, all_days.where(days))
    return root


def q_ed_first_seen_incremental(spark, sf):
    """First snapshot per emergency stay, merged from four ranges of days."""
    from bedflow.operators import state
    return state.first_seen(spark, _first_seen_state(spark, sf))


def q_ed_reclassification_incremental(spark, sf):
    from bedflow.operators import state
    return state.reclassification_rate(spark, _first_seen_state(spark, sf), P)


#: Ranges of days asked of the daily sketches: all, four years, a quarter, one week, one day.
SKETCH_RANGES = {"all": (dt.date(1990, 1, 1), dt.date(2100, 1, 1)), "years": (dt.date(1994, 1, 1), dt.date(1997, 12, 31)),
                 "quarter": (dt.date(1995, 4, 1), dt.date(1995, 6, 30)), "week": (dt.date(1996, 2, 26), dt.date(1996, 3, 3)),
                 "day": (dt.date(1996, 2, 29), dt.date(1996, 2, 29))}
SKETCH_COLUMNS, SKETCH_NUMERIC = ["contact_serial_number", "service_code", "location"], ["beddeddays"]


def _sketch_state(spark, sf):
    """Daily sketches of the encounters, delivered in three batches that share days."""
    from bedflow.operators import sketches
    root, rows = _folder(spark, "sketches"), _enc(spark, sf)
    admitted = F.col("admit_date")
    for days in (admitted < F.lit(dt.date(1996, 3, 1)), admitted >= F.lit(dt.date(1996, 2, 1)),
                 admitted.between(F.lit(dt.date(1995, 5, 1)), F.lit(dt.date(1995, 5, 20)))):
        sketches.keep_days(spark, root, stage(sketches.daily_sketches(
            rows.where(days), "admit_date", SKETCH_COLUMNS, SKETCH_NUMERIC), "daily-sketches"))
    return root


def q_sketched_profile(spark, sf):
    """Per range of days and column: the exact counts, and whether the estimates
    from merged daily sketches are within their errors of the exact figures."""
    from bedflow.operators import sketches
    root, names = _sketch_state(spark, sf), [*SKETCH_COLUMNS, *SKETCH_NUMERIC]
    asked = [sketches.estimates(sketches.merged(sketches.stored_days(spark, root, a, b))).select(
        F.lit(k).alias("range"), "column_name", "n_rows", "n_nulls", "approx_distinct", "p25", "p50", "p75")
        for k, (a, b) in SKETCH_RANGES.items()]
    estimated = asked[0]
    for more in asked[1:]:
        estimated = estimated.unionByName(more)
    in_range = F.array_compact(F.array(*[F.when(F.col("admit_date").between(F.lit(a), F.lit(b)), F.lit(k))
                                         for k, (a, b) in SKETCH_RANGES.items()]))
    exact = (_enc(spark, sf).select(F.explode(in_range).alias("range"), *names)
             .select("range", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v"))
                                                  for c in names])).alias("x")).select("range", "x.*")
             .groupBy("range", "column_name", "v").agg(F.count(F.lit(1)).alias("n")))
    # ranks of the estimated quantiles: rows below and up to each value
    number = F.when(F.col("column_name").isin(SKETCH_NUMERIC), F.col("v").cast("double"))
    both = exact.join(estimated, ["range", "column_name"])
    held = F.sum(F.when(number.isNotNull(), F.col("n")))
    checks = [F.coalesce((F.sum(F.when(number < F.col(p), F.col("n")).otherwise(0)) <= (q + sketches.rank_error()) * held)
                         & (F.sum(F.when(number <= F.col(p), F.col("n")).otherwise(0)) >= (q - sketches.rank_error()) * held),
                         held.isNull()).alias(f"{p}_close") for p, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))]
    out = both.groupBy("range", "column_name", "n_rows", "n_nulls", "approx_distinct").agg(
        F.count("v").alias("n_distinct"), *checks)
    close = F.abs(F.col("approx_distinct") - F.col("n_distinct")) <= F.ceil(
        F.col("n_distinct") * sketches.distinct_error())
    return out.select("range", "column_name", "n_rows", "n_nulls", "n_distinct", close.alias("distinct_close"),
                      "p25_close", "p50_close", "p75_close")


def q_encounter_dense_rank(spark, sf):
    """Days and services in order, over all encounters, without one window over them."""
    from bedflow.operators.ranking import dense_rank
    rows = _enc(spark, sf).select("contact_serial_number", "admit_date", "service_code", "admit_type")
    return dense_rank(rows, ["admit_date", "service_code", "admit_type"])


# ---------------------------------------------------------------- FHIR ------
def _parsed(spark, sf):
    from bedflow.sources.json_docs import fhir_documents, parse_documents
    return parse_documents(fhir_documents(spark, sf))


def _resource(spark, sf, resource, arrays=()):
    """Parsed documents of one resource, staged once, and its column plan with
    the elements of ``arrays``.  Only this resource's part of the export is built."""
    from bedflow.operators import fhir as H
    from bedflow.sources.json_docs import RESOURCE_DOCUMENTS, parse_documents
    parsed = stage(parse_documents(RESOURCE_DOCUMENTS[resource](spark, sf))
                   .where(F.col("resource_type") == resource).select("doc", "resource_type"), f"fhir-{resource}")
    return parsed, H.document_plan(parsed, {resource: arrays})


def q_fhir_schema(spark, sf):
    from bedflow.operators.fhir import infer_schema
    return infer_schema(_parsed(spark, sf))


def _resource_rows(spark, sf, resource):
    from bedflow.operators import fhir as H
    parsed, plan = _resource(spark, sf, resource)
    scalar_or_object = [c for c in plan[resource].columns if c[1] != "ARRAY"] if plan else []
    return H.comparable(H.shred(parsed, resource, scalar_or_object))


def q_fhir_resource_rows(spark, sf):
    return _resource_rows(spark, sf, "Claim")


def q_fhir_patient_rows(spark, sf):
    return _resource_rows(spark, sf, "Patient")


def q_fhir_encounter_rows(spark, sf):
    return _resource_rows(spark, sf, "Encounter")


def _child(spark, sf, resource, source_col):
    from bedflow.operators import fhir as H
    parsed, plan = _resource(spark, sf, resource, [source_col.lower()])
    return H.comparable(H.child_rows(parsed, plan, resource, source_col))


def q_fhir_child_rows(spark, sf):
    return _child(spark, sf, "Claim", "ITEM")


def q_fhir_address_rows(spark, sf):
    return _child(spark, sf, "Patient", "ADDRESS")


def q_fhir_participant_rows(spark, sf):
    return _child(spark, sf, "Encounter", "PARTICIPANT")


def q_fhir_child_schema(spark, sf):
    from bedflow.operators import fhir as H
    parsed, plan = _resource(spark, sf, "Claim")
    elements = H.document_elements(parsed, "Claim", H.arrays_named(plan["Claim"], "ITEM")[0], "ITEM")
    return H.child_schema(elements).select(F.lit("FHIR_CLAIM_ITEM").alias("target_table"), "*")


def q_fhir_rejects(spark, sf):
    """Documents of a messy export that are no resources, with the reason."""
    from bedflow.sources.json_docs import messy_documents, parse_documents, rejects
    return rejects(parse_documents(messy_documents(spark, sf)))


def q_fhir_mixed_child_rows(spark, sf):
    """Children of claims whose item is an array in some documents only, with
    object and primitive elements."""
    from bedflow.operators import fhir as H
    from bedflow.sources.json_docs import messy_documents, parse_documents
    parsed = stage(parse_documents(messy_documents(spark, sf)).select("doc", "resource_type"), "fhir-messy")
    return H.comparable(H.child_rows(parsed, H.document_plan(parsed, {"Claim": ["item"]}), "Claim", "ITEM"))


def q_fhir_path_schema(spark, sf):
    """Every path of every resource, array indexes normalised, with its type."""
    from bedflow.operators.fhir import path_schema
    return path_schema(_parsed(spark, sf))


def q_fhir_case_variants(spark, sf):
    """Claims whose resource and properties come in several spellings, some
    called like the ingest's own columns, in two batches, the second twice;
    read back from the one table they share."""
    from bedflow.operators.fhir import bulk_ingest, read_ingested
    from bedflow.sources.json_docs import spelling_documents
    root = _folder(spark, "case-variants")
    docs = spelling_documents(spark, sf)
    for batch in (0, 1, 1):
        bulk_ingest(docs.where(F.col("batch") == batch).select("file_row"), root, batch_id=batch)
    # -1 where a row's number went to the column of text
    return read_ingested(spark, f"{root}/FHIR_CLAIM").withColumn("seq", F.coalesce("seq", F.lit(-1)))


# ---------------------------------------------------------- monitoring ------
def q_model_dictionary(spark, sf):
    from bedflow.operators.monitor import model_dictionary
    cpc_rows, edc_rows = _cpc_and_edc(spark, sf)
    return model_dictionary(cpc_rows.unionByName(edc_rows))


def q_column_profile(spark, sf):
    from bedflow.operators.monitor import column_profile
    return column_profile(_enc(spark, sf))


def q_seasonal_fit(spark, sf):
    from bedflow.operators.monitor import seasonal_fit
    e, cal, hol = _enc(spark, sf), date_dim(spark, P), holiday_dim(spark, P)
    return seasonal_fit(fuec.fuec_seasonal_mean(e, cal, hol, P), fuec.fuec_daily_arrivals(e, P),
                             fuec.history_days(cal, hol, P), fuec.KEYS)


def q_column_quantiles(spark, sf):
    from bedflow.operators.monitor import column_quantiles
    return column_quantiles(_enc(spark, sf), ["beddeddays"], by=["patient_type", "service_code"], exact=True)


def q_column_distribution(spark, sf):
    from bedflow.operators.monitor import column_distribution
    return column_distribution(_enc(spark, sf), ["service_code", "care_class", "admit_type"], ["beddeddays"])


def q_census_accuracy(spark, sf):
    """Both models against the stays as they are known a horizon later."""
    from bedflow.operators.monitor import census_accuracy
    cpc_rows, edc_rows = _cpc_and_edc(spark, sf)
    known = encounters(spark, sf, CENSUS_PARAMS).select(
        F.col("contact_serial_number").alias("stay_key"), "admit_date", "beddeddays")
    return census_accuracy(cpc_rows.unionByName(edc_rows), known)


def q_census_sweep(spark, sf):
    """Past stays in bed per service and day, from first admission to last day."""
    from bedflow.operators.sweep import census
    return census(past_stays(_enc(spark, sf)), ["service_code"])


#: Dates from which the models are tried on the fixture, and the days forecast.
ORIGINS = [dt.date(1999, m, d) for m in (6, 8, 10, 12) for d in (1, 16)]
ORIGIN_DAYS = 14


def _known_stays(spark, sf):
    """Stays known to their end, long after the last origin."""
    return past_stays(encounters(spark, sf, CENSUS_PARAMS)).withColumnRenamed("contact_serial_number", "stay_key")


def _forecast_cells(spark, sf):
    from bedflow.operators.evaluation import forecast_cells
    return forecast_cells(_known_stays(spark, sf), ORIGINS, ORIGIN_DAYS)


def _forecast_errors(spark, sf):
    from bedflow.operators.evaluation import forecast_errors, origin_reclassification
    weights = origin_reclassification(cake_snapshot(spark, sf), ORIGINS, P)
    return forecast_errors(_forecast_cells(spark, sf), weights)


def q_rolling_forecast_errors(spark, sf):
    """Both models as of eight dates, day by day, against what happened."""
    rounded = [(F.round(c, 6) + 0.0).alias(c) for c in ("predicted", "error")]
    return _forecast_errors(spark, sf).select("model_name", "as_of", "horizon_day", "patients", "realised", *rounded)


def q_rolling_accuracy(spark, sf):
    from bedflow.operators.evaluation import accuracy
    return accuracy(_forecast_errors(spark, sf))


def q_stay_rate_calibration(spark, sf):
    from bedflow.operators.evaluation import calibration
    return calibration(_forecast_cells(spark, sf))


def q_brier_decomposition(spark, sf):
    from bedflow.operators.evaluation import brier
    return brier(_forecast_cells(spark, sf))


def q_table_model_sample(spark, sf):
    from bedflow.plans.table_model import sample_input
    return sample_input(q_cpc_model(spark, sf), 5)


def q_los_percentile_by_season(spark, sf):
    from bedflow.operators.monitor import los_percentile_by_season
    return los_percentile_by_season(_enc(spark, sf))


# ------------------------------------------------- classifier, table model --
def q_los_classifier(spark, sf):
    from bedflow.operators import classify
    model, test = classify.fit(_enc(spark, sf))
    return classify.predictions(model, test)


def q_los_forest_rescored(spark, sf):
    """The saved forest, loaded again and scored twice: by the loaded pipeline and by
    its table of nodes, published and read back.  ``agrees`` per held-out stay."""
    from bedflow.operators import classify, forest_table
    from bedflow.sources import published
    model, test = classify.fit(_enc(spark, sf))
    path, root = _folder(spark, "los-model"), _folder(spark, "los-nodes")
    classify.save(model, path)
    published.replace(forest_table.node_table(spark, path), root)
    loaded = classify.load(path)
    by_model = classify.predictions(loaded, test).withColumnRenamed("prediction", "by_model")
    by_nodes = classify.table_predictions(loaded, published.read(spark, root), test)
    return by_nodes.join(by_model.drop("label"), "contact_serial_number").select(
        "contact_serial_number", "label", F.col("prediction").eqNullSafe(F.col("by_model")).alias("agrees"))


def q_classification_report(spark, sf):
    from bedflow.operators import classify
    return classify.classification_report(q_los_classifier(spark, sf))


def _classifier_rows(spark, sf):
    from bedflow.operators import classify
    return classify.classifier_input(_enc(spark, sf))


def q_los_split_counts(spark, sf):
    from bedflow.operators import classify
    return classify.split_counts(_classifier_rows(spark, sf))


def q_los_scaler_stats(spark, sf):
    from bedflow.operators import classify
    return classify.scaler_stats(_classifier_rows(spark, sf))


def q_baseline_report(spark, sf):
    """The report over a prediction that SQL can make, too."""
    from bedflow.operators import classify
    return classify.classification_report(classify.baseline_predictions(_classifier_rows(spark, sf)))


def q_table_model(spark, sf):
    from bedflow.plans.table_model import table_model
    return table_model(q_cpc_model(spark, sf))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}

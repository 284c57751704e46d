"""FHIR ingest on literal documents: conflicting types, JSON nulls, empty and
null arrays, malformed text."""
import pytest

from bedflow.operators import fhir as H
from bedflow.sources.json_docs import parse_documents, rejects

DOCS = [
    '{"resourceType":"Claim","id":"1","total":10.5,"item":[{"sequence":1,"net":2.5},{"sequence":2,"net":3}]}',
    '{"resourceType":"Claim","id":"2","total":7,"item":[]}',
    '{"resourceType":"Claim","id":"3","total":"n/a","item":null,"note":null}',
    '{"resourceType":"Patient","id":"p1","address":[{"country":"X"}],"active":true}',
    'not json at all',
    '{"id":"no type"}',
]


@pytest.fixture
def parsed(spark):
    return parse_documents(spark.createDataFrame([(d,) for d in DOCS], "file_row string"))


def test_schema_lists_every_seen_type(parsed):
    rows = {(r.fhir_resource, r.property, r.col_type) for r in H.infer_schema(parsed).collect()}
    assert ("Claim", "total", "DECIMAL") in rows
    assert ("Claim", "total", "INTEGER") in rows
    assert ("Claim", "total", "TEXT") in rows
    assert ("Claim", "note", "NULL_VALUE") in rows
    assert ("Claim", "item", "ARRAY") in rows
    assert ("Claim", "item", "NULL_VALUE") in rows
    assert ("Patient", "active", "BOOLEAN") in rows


def test_merged_column_types(parsed):
    plan = H.column_plan(H.resource_columns(parsed), "resource_type")
    claim = {p: t for p, _, t in plan["Claim"]}
    assert claim["total"] == "variant"  # number vs text conflict stays VARIANT
    assert claim["id"] == "string"
    assert claim["item"] == "variant"


def test_rejects(parsed):
    assert rejects(parsed).count() == 2


def test_children_skip_empty_and_null_arrays(parsed):
    plan = H.column_plan(H.resource_columns(parsed), "resource_type")
    rows = H.shred(parsed, "Claim", plan["Claim"])
    target, child = H.child_table(rows, "Claim", plan["Claim"], "ITEM")
    assert target == "FHIR_CLAIM_ITEM"
    got = sorted((r.PARENT_ID, r.sequence, float(r.net)) for r in child.collect())
    assert got == [("1", 1, 2.5), ("1", 2, 3.0)]
    assert child.columns[:3] == ["PARENT_RESOURCE", "SOURCE_COL", "PARENT_ID"]


def test_gate_skips_missing_or_non_array(parsed):
    plan = H.column_plan(H.resource_columns(parsed), "resource_type")
    rows = H.shred(parsed, "Claim", plan["Claim"])
    assert H.child_table(rows, "Claim", plan["Claim"], "DIAGNOSIS") is None


def test_bulk_ingest_writes_tables(spark, tmp_path):
    docs = spark.createDataFrame([(d,) for d in DOCS], "file_row string")
    written = H.bulk_ingest(docs, str(tmp_path))
    assert {"FHIR_CLAIM", "FHIR_PATIENT", "FHIR_CLAIM_ITEM", "FHIR_ADDRESS"} <= set(written)
    assert spark.read.parquet(written["FHIR_CLAIM"]).count() == 3
    assert spark.read.parquet(written["FHIR_CLAIM_ITEM"]).count() == 2
    assert spark.read.parquet(written["FHIR_ADDRESS"]).count() == 1


def test_primitive_array_children(spark):
    docs = spark.createDataFrame([('{"resourceType":"Patient","id":"p","communication":["en","fr"]}',)],
                                 "file_row string")
    parsed = parse_documents(docs)
    plan = H.column_plan(H.resource_columns(parsed), "resource_type")
    rows = H.shred(parsed, "Patient", plan["Patient"])
    target, child = H.child_table(rows, "Patient", plan["Patient"], "COMMUNICATION")
    assert target == "FHIR_PATIENT_COMMUNICATION"
    assert sorted(r.value for r in child.collect()) == ["en", "fr"]


def test_empty_input_gives_nothing(spark, tmp_path):
    docs = spark.createDataFrame([], "file_row string")
    assert H.infer_schema(parse_documents(docs)).count() == 0
    assert H.bulk_ingest(docs, str(tmp_path)) == {}
    assert not list(tmp_path.iterdir())


def ingest(spark, path, docs, batch):
    return H.bulk_ingest(spark.createDataFrame([(d,) for d in docs], "file_row string"), str(path), batch_id=batch)


def test_second_batch_adds_only_its_own_children(spark, tmp_path):
    one = ['{"resourceType":"Claim","id":"1","item":[{"sequence":1},{"sequence":2}]}']
    two = ['{"resourceType":"Claim","id":"2","item":[{"sequence":7}]}']
    ingest(spark, tmp_path, one, 0)
    for _ in range(2):  # a repeated batch replaces itself
        written = ingest(spark, tmp_path, two, 1)
    rows = H.read_ingested(spark, written["FHIR_CLAIM_ITEM"]).collect()
    assert sorted((r.PARENT_ID, r.sequence, r.ingest_batch) for r in rows) == [
        ("1", 1, 0), ("1", 2, 0), ("2", 7, 1)]
    assert H.read_ingested(spark, written["FHIR_CLAIM"]).count() == 2


def test_other_types_in_a_later_batch_stay_readable(spark, tmp_path):
    ingest(spark, tmp_path, ['{"resourceType":"Claim","id":"1","n":1,"d":1.5,"item":[{"sequence":1}]}'], 0)
    ingest(spark, tmp_path, ['{"resourceType":"Claim","id":"2","n":"two","d":1234.25,"item":[{"sequence":"b"}]}'], 1)
    rows = {r.id: r for r in H.read_ingested(spark, f"{tmp_path}/FHIR_CLAIM").collect()}
    assert rows["1"].n == 1 and rows["2"].n is None and rows["2"]["n__string"] == "two"
    assert float(rows["2"].d) == 1234.25  # longer numbers are no other type
    kids = {r.PARENT_ID: r for r in H.read_ingested(spark, f"{tmp_path}/FHIR_CLAIM_ITEM").collect()}
    assert kids["1"].sequence == 1 and kids["2"]["sequence__string"] == "b"


def test_one_object_among_arrays_keeps_the_child_table(spark, tmp_path):
    written = ingest(spark, tmp_path, ['{"resourceType":"Claim","id":"1","item":[{"sequence":1}]}',
                                       '{"resourceType":"Claim","id":"2","item":{"sequence":2}}'], 0)
    assert [r.PARENT_ID for r in spark.read.parquet(written["FHIR_CLAIM_ITEM"]).collect()] == ["1"]
    assert spark.read.parquet(written["FHIR_CLAIM"]).count() == 2


def test_property_called_value_is_kept(spark, tmp_path):
    written = ingest(spark, tmp_path, [
        '{"resourceType":"Claim","id":"1","item":[{"url":"u","value":"x"},"y",{"url":"v"}]}'], 0)
    rows = spark.read.parquet(written["FHIR_CLAIM_ITEM"]).collect()
    assert sorted((r.url or "", r.value or "") for r in rows) == [("", "y"), ("u", "x"), ("v", "")]


def test_resources_without_id_and_rejects_are_written(spark, tmp_path):
    written = ingest(spark, tmp_path, ['{"resourceType":"Claim","item":[{"sequence":1}]}', "nonsense", '{"id":"x"}'], 0)
    assert [r.PARENT_ID for r in spark.read.parquet(written["FHIR_CLAIM_ITEM"]).collect()] == [None]
    assert sorted(r.reason for r in spark.read.parquet(written["FHIR_REJECTS"]).collect()) == [
        "no resourceType", "not JSON"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["FHIR_CLAIM", "FHIR_CLAIM_ITEM", "FHIR_REJECTS"]

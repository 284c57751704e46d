"""Ingest of documents that clash in names, types and numbers; the ledger;
schemas of whole documents."""
import json
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bedflow.operators import fhir as H
from bedflow.operators import ledger
from bedflow.operators.variant_schema import parse, paths
from bedflow.sources.json_docs import parse_documents


def ingest(spark, path, docs, batch=0):
    frame = spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "file_row string")
    return H.bulk_ingest(frame, str(path), batch_id=batch)


def table(spark, path, name):
    return [r.asDict() for r in H.read_ingested(spark, f"{path}/{name}").collect()]


def test_resources_that_differ_in_case_share_a_table(spark, tmp_path):
    ingest(spark, tmp_path, [{"resourceType": "Claim", "id": "1", "total": 10.5},
                             {"resourceType": "CLAIM", "id": "2", "total": 7, "item": [{"n": 1}]}])
    rows = {r["id"]: r for r in table(spark, tmp_path, "FHIR_CLAIM")}
    assert set(rows) == {"1", "2"} and rows["1"]["resourceType"] == "Claim" and rows["2"]["resourceType"] == "CLAIM"
    assert {r["total"] or r.get("total__decimal") for r in rows.values()} == {Decimal("10.5"), 7}
    assert [r["PARENT_ID"] for r in table(spark, tmp_path, "FHIR_CLAIM_ITEM")] == ["2"]


def test_properties_that_differ_in_case_get_columns_of_their_own(spark, tmp_path):
    ingest(spark, tmp_path, [{"resourceType": "Claim", "id": "1", "Item": 1, "item": [{"net": 2, "Net": 3}]}])
    row, = table(spark, tmp_path, "FHIR_CLAIM")
    assert row["Item"] == 1 and row["item__2"] is not None
    child, = table(spark, tmp_path, "FHIR_CLAIM_ITEM")
    assert (child["Net"], child["net__2"]) == (3, 2)
    # a later batch that has the other spelling only meets the same columns
    ingest(spark, tmp_path, [{"resourceType": "Claim", "id": "2", "item": [{"net": 5}]}], 1)
    assert {r["PARENT_ID"]: r["net__2"] for r in table(spark, tmp_path, "FHIR_CLAIM_ITEM")} == {"1": 2, "2": 5}


def test_both_spellings_of_an_array_have_children(spark, tmp_path):
    ingest(spark, tmp_path, [{"resourceType": "Claim", "id": "1", "Item": [{"n": 1}], "item": [{"n": 2}, {"m": 3}]}])
    assert sorted((r["n"] or 0, r["m"] or 0) for r in table(spark, tmp_path, "FHIR_CLAIM_ITEM")) == [(0, 3), (1, 0), (2, 0)]


@pytest.mark.parametrize("name", ["parent_id", "PARENT_RESOURCE", "ingest_batch", "Source_Col"])
def test_names_of_the_ingest_are_kept_apart(spark, tmp_path, name):
    ingest(spark, tmp_path, [{"resourceType": "Claim", "id": "1", name: "mine", "item": [{name: "theirs"}]}], 7)
    parent, = table(spark, tmp_path, "FHIR_CLAIM")
    child, = table(spark, tmp_path, "FHIR_CLAIM_ITEM")
    assert "mine" in parent.values() and parent["ingest_batch"] == 7
    assert child[f"{name}__2"] == "theirs" and child["PARENT_ID"] == "1" and child["PARENT_RESOURCE"] == "FHIR_CLAIM"


def test_a_repeated_batch_leaves_no_stale_table(spark, tmp_path):
    ingest(spark, tmp_path, [{"resourceType": "Claim", "id": "1", "item": [{"n": 1}]}, "nonsense"], 0)
    ingest(spark, tmp_path, [{"resourceType": "Claim", "id": "2", "item": [{"n": 2}]}], 1)
    written = ingest(spark, tmp_path, [{"resourceType": "Patient", "id": "p"}], 0)
    assert set(written) == {"FHIR_PATIENT"}
    assert [r["id"] for r in table(spark, tmp_path, "FHIR_CLAIM")] == ["2"]
    assert [r["PARENT_ID"] for r in table(spark, tmp_path, "FHIR_CLAIM_ITEM")] == ["2"]
    assert not list((tmp_path / "FHIR_REJECTS").glob("ingest_batch=*"))


def test_numbers_keep_their_digits(spark, tmp_path):
    texts = ["0.1234567890123456789", "12345678901234567890123456789012345", "1.5", "-7", "1e2"]
    ingest(spark, tmp_path, [f'{{"resourceType":"Claim","id":"{i}","d":{t}}}' for i, t in enumerate(texts)])
    got = dict(H.read_ingested(spark, f"{tmp_path}/FHIR_CLAIM").selectExpr("id", "to_json(d)").collect())
    assert [Decimal(str(got[str(i)])) for i in range(5)] == [Decimal(t) for t in texts]  # VARIANT: no type holds all


@pytest.mark.parametrize("values,kind", [
    (["1.25", "3"], "decimal(38,9)"), (["0.12345678901", "1"], "decimal(38,18)"), (["1", "2"], "bigint"),
    (["1e2", "2e-3"], "double"), (["1e2", "1.5"], "double"), (["1e2", "0.12345678901234567"], "variant"),
    (["0." + "1" * 30, "5"], "decimal(38,30)"), (["0." + "1" * 30, "1234567890"], "variant"), (["1", '"x"'], "variant")])
def test_types_that_hold_all_values(spark, values, kind):
    docs = [f'{{"resourceType":"Claim","d":{v},"item":[{{"e":{v}}}]}}' for v in values]
    plan = H.document_plan(parse_documents(spark.createDataFrame([(d,) for d in docs], "file_row string")))["Claim"]
    assert {p: t for p, _, t in plan.columns}["d"] == kind
    assert {p: t for p, _, t in plan.children["item"]}["e"] == kind


def test_odd_property_names(spark, tmp_path):
    odd = {"it's": 1, 'say "x"': 2, "both ' and \"": 3, "": 4, "a.b": 5, "`tick`": 6, "a,b;c{}=(\t)": 7, "é": 8}
    ingest(spark, tmp_path, [{"resourceType": "Claim", "id": "1", **odd}])
    row, = table(spark, tmp_path, "FHIR_CLAIM")
    assert {k: row[k or "_"] for k in odd} == odd


def test_a_resource_called_like_a_child_table(spark, tmp_path):
    ingest(spark, tmp_path, [{"resourceType": "Claim", "id": "1", "item": [{"n": 1}]},
                             {"resourceType": "Claim_Item", "id": "2", "n": "text"},
                             {"resourceType": "Rejects", "id": "3"}, "no document"])
    rows = table(spark, tmp_path, "FHIR_CLAIM_ITEM")
    assert len(rows) == 2 and {r["PARENT_ID"] for r in rows} == {"1", None}
    rejects = table(spark, tmp_path, "FHIR_REJECTS")
    assert {(r["id"], r["reason"]) for r in rejects} == {("3", None), (None, "not JSON")}


def test_ledger_tells_where_a_column_came_from(spark, tmp_path):
    ingest(spark, tmp_path, [{"resourceType": "Claim", "id": "1", "n": 1}], 0)
    ingest(spark, tmp_path, [{"resourceType": "Claim", "id": "2", "n": "two", "N": 2.5, "x": None}], 1)
    ingest(spark, tmp_path, [{"resourceType": "Claim", "id": "3", "n": None, "N": 4}], 2)
    got = {(r["property"], r["type"]): (r["column"], r["first_batch"]) for r in ledger.read(spark, f"{tmp_path}/FHIR_CLAIM").collect()}
    assert got[("n", "bigint")] == ("n", "0") and got[("n", "string")] == ("n__string", "1")
    assert got[("N", "decimal(38,9)")] == ("N__2", "1") and len(got) == 6  # whole numbers fit the decimal
    assert {r["id"]: r["N__2"] for r in table(spark, tmp_path, "FHIR_CLAIM")} == {"1": None, "2": Decimal("2.5"), "3": 4}


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["a", "A", "a__2", "b", "_", "", "key"]),
                                   st.sampled_from(["string", "bigint", "decimal(38,9)", "variant"]), st.booleans()),
                         max_size=6), max_size=5))
def test_ledger_assignments_are_stable_and_unique(batches):
    have = []
    first = {}
    for i, columns in enumerate(batches):
        columns = list({c[0]: c for c in columns}.values())  # a batch has one type a property
        out, new = ledger.assign(have, columns, ["KEY"], str(i))
        have = have + new
        names = [e.column.lower() for e in have]
        assert len(set(names)) == len(names) and "key" not in names
        assert len({e.column.lower() for e in out}) == len(columns)
        for (name, kind, null), e in zip(columns, out):
            assert e.property == name and (null or ledger.holds(e.type, kind))
            if not null:
                assert first.setdefault((name, kind), e) == e


def test_schema_text_is_read_back():
    text = "OBJECT<``: BIGINT, A: DECIMAL(8,2), `b c`: ARRAY<OBJECT<`q``q`: VOID, x: ARRAY<STRING>>>, é: OBJECT<s: TIMESTAMP_NTZ>>"
    tree = parse(text)
    assert list(tree.fields) == ["", "A", "b c", "é"] and tree.fields["A"].size == (8, 2)
    assert dict(paths(tree)) == {
        "['']": "BIGINT", "A": "DECIMAL", "b c": "ARRAY", "b c[]": "OBJECT", "b c[].q`q": "VOID", "b c[].x": "ARRAY",
        "b c[].x[]": "STRING", "é": "OBJECT", "é.s": "TIMESTAMP_NTZ"}


def test_plan_of_whole_documents_needs_no_generate(spark):
    docs = spark.createDataFrame([('{"resourceType":"Claim","id":"1","item":[{"n":1},{"n":2}]}',)], "file_row string")
    from pyspark.sql import functions as F
    merged = parse_documents(docs).groupBy("resource_type").agg(F.schema_of_variant_agg("doc"))
    assert "Generate" not in merged._jdf.queryExecution().executedPlan().toString()
    plan = H.document_plan(parse_documents(docs))["Claim"]
    assert plan.children == {"item": [("n", "BIGINT", "bigint")]}
    assert H.document_plan(parse_documents(docs.limit(0))) == {}
    assert H.path_schema(parse_documents(docs.limit(0))).count() == 0

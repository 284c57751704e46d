"""Bulk FHIR ingest: infer a schema per resource type, shred each resource
into a typed table, and explode mapped array columns into child tables.

Everything data-sized stays in Spark.  The only driver round trips are the
column plans: one schema per resource (``document_plan``), bounded by the
number of distinct property names, never by the number of documents or values.
Documents are parsed once into VARIANT and staged, partitioned by resource
type, in the shared folder; each resource's projection then reads only its own
partition.

Every table is written as one partition per batch (``ingest_batch``), which a
repeated batch replaces, also in tables that it no longer writes.  Nothing is
lost to names or types: resources whose names differ only in case share a
table, and a ledger (``operators.ledger``) gives each spelling and type of a
property a column of its own, the same one in every batch.  Numbers keep their
digits: what neither a decimal nor a double holds exactly stays VARIANT.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bedflow.operators import ledger
from bedflow.operators.variant_schema import Node, document_trees, paths
from bedflow.sources.json_docs import parse_documents, rejects
from bedflow.sources.sinks import discard, stage

# Resource table -> {array property: child table}.
CHILD_TABLES: dict[str, dict[str, str]] = {
    "FHIR_CAREPLAN": {"ACTIVITY": "FHIR_CAREPLAN_ACTIVITY"},
    "FHIR_CARETEAM": {"PARTICIPANT": "FHIR_CARETEAM_PARTICIPANT"},
    "FHIR_CLAIM": {
        "DIAGNOSIS": "FHIR_CLAIM_DIAGNOSIS",
        "INSURANCE": "FHIR_CLAIM_INSURANCE",
        "ITEM": "FHIR_CLAIM_ITEM",
        "PROCEDURE": "FHIR_CLAIM_PROCEDURE",
    },
    "FHIR_DEVICE": {
        "DEVICENAME": "FHIR_DEVICE_DEVICE_NAME",
        "UDICARRIER": "FHIR_DEVICE_UDI_CARRIER",
    },
    "FHIR_DIAGNOSTICREPORT": {"PRESENTEDFORM": "FHIR_ATTACHMENT"},
    "FHIR_DOCUMENTREFERENCE": {"CONTENT": "FHIR_DOCUMENTREFERENCE_CONTENT"},
    "FHIR_ENCOUNTER": {"PARTICIPANT": "FHIR_ENCOUNTER_PARTICIPANT"},
    "FHIR_EXPLANATIONOFBENEFIT": {
        "CARETEAM": "FHIR_EXPLANATIONOFBENEFIT_CARETEAM",
        "CONTAINED": "FHIR_EXPLANATIONOFBENEFIT_CONTAINED",
        "DIAGNOSIS": "FHIR_EXPLANATIONOFBENEFIT_DIAGNOSIS",
        "INSURANCE": "FHIR_EXPLANATIONOFBENEFIT_INSURANCE",
        "ITEM": "FHIR_EXPLANATIONOFBENEFIT_ITEM",
    },
    "FHIR_MEDICATIONREQUEST": {"DOSAGEINSTRUCTION": "FHIR_DOSAGE"},
    "FHIR_PATIENT": {
        "ADDRESS": "FHIR_ADDRESS",
        "COMMUNICATION": "FHIR_PATIENT_COMMUNICATION",
        "EXTENSION": "FHIR_EXTENSION",
    },
}

# Variant type -> column type name of the ingest.
TYPE_NAMES = {
    "STRING": "TEXT",
    "BIGINT": "INTEGER",
    "DECIMAL": "DECIMAL",
    "DOUBLE": "DOUBLE",
    "FLOAT": "DOUBLE",
    "BOOLEAN": "BOOLEAN",
    "OBJECT": "VARIANT",
    "VARIANT": "VARIANT",
    "ARRAY": "ARRAY",
    "VOID": "NULL_VALUE",
    "DATE": "DATE",
    "TIMESTAMP": "TIMESTAMP",
    "TIMESTAMP_NTZ": "TIMESTAMP_NTZ",
    "BINARY": "BINARY",
}
# Variant types that become a typed scalar column; the rest stay VARIANT.
SCALAR_HEADS = ("STRING", "BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "BOOLEAN",
                "DATE", "TIMESTAMP", "TIMESTAMP_NTZ", "BINARY")
PARENT_COLUMNS = ("PARENT_RESOURCE", "SOURCE_COL", "PARENT_ID")
PRIMITIVE_COLUMN = "value"
BATCH_COLUMN = "ingest_batch"
REJECTS_TABLE = "FHIR_REJECTS"
#: Tables written at the same time.
WRITERS = 4


def table_name(resource: str) -> str:
    return "FHIR_" + resource.upper()


def property_value(obj: str, prop: str, kind: str) -> Column:
    """A property of an object column as a type; NULL where it is missing or does not fit."""
    for quote in "'\"":
        if prop and quote not in prop:
            return F.try_variant_get(F.col(obj), f"$[{quote}{prop}{quote}]", kind)
    value = F.try_element_at(F.try_variant_get(F.col(obj), "$", "map<string,variant>"), F.lit(prop))
    return F.try_variant_get(value, "$", kind)


def head_type(schema: Column) -> Column:
    """First word of a variant schema string: 'ARRAY<...>' -> 'ARRAY'."""
    return F.regexp_extract(schema, r"^[A-Z_]+", 0)


def type_name(value: Column) -> Column:
    """``typeof`` of a variant value in the ingest's vocabulary (X11, X13)."""
    head = head_type(F.schema_of_variant(value))
    out = F.lit(None).cast("string")
    for k, v in reversed(TYPE_NAMES.items()):
        out = F.when(head == k, F.lit(v)).otherwise(out)
    return F.coalesce(out, head)


def properties(objects: DataFrame, obj: str, keep: list[str]) -> DataFrame:
    """Lateral flatten of an object column, non-recursive (H1):
    (keep..., property, value) per top-level property."""
    kv = F.explode(F.try_variant_get(F.col(obj), "$", "map<string,variant>"))
    return objects.select(*keep, kv.alias("property", "value"))


def infer_schema(parsed: DataFrame) -> DataFrame:
    """(fhir_resource, property, col_type): every type seen per property (H3).
    A property seen with two types gives two rows, JSON null included."""
    p = properties(parsed.where(F.col("resource_type").isNotNull()), "doc", ["resource_type"])
    return (p.select(F.col("resource_type").alias("fhir_resource"), "property",
                     type_name(F.col("value")).alias("col_type"))
            .distinct())


def exact_decimal(whole: int, scale: int) -> str:
    """The decimal for numbers of so many digits before and behind the point.
    Few different ones, so that a batch with longer numbers has no other type;
    VARIANT where 38 digits do not hold them."""
    for width in (9, 18, scale):
        if scale <= width and whole <= 38 - width:
            return f"decimal(38,{width})"
    return "variant"


#: Digits that a double keeps.
DOUBLE_DIGITS = 15


def _column_types(props: DataFrame, keys: list[str]) -> DataFrame:
    """One merged Spark type per property, from its values: nulls dropped,
    numerics widened as long as no digit is lost, other conflicts VARIANT (N14);
    objects and arrays stay VARIANT.  A property that holds an array in any
    document counts as ARRAY: the gate looks at values, not at the merged type."""
    schema = F.schema_of_variant("value")
    head = head_type(schema)
    numbers = F.regexp_extract(schema, r"\((\d+),(\d+)\)", 1), F.regexp_extract(schema, r"\((\d+),(\d+)\)", 2)
    precision, scale = (F.when(head == "DECIMAL", x.cast("int")) for x in numbers)
    digits = F.when(head == "BIGINT", F.length(F.try_variant_get("value", "$", "decimal(38,0)").cast("string")))
    merged = F.schema_of_variant_agg("value")
    arrays = F.bool_or(F.try_variant_get("value", "$", "array<variant>").isNotNull())
    found = props.groupBy(*keys, "property").agg(
        merged.alias("_merged"), arrays.alias("_arrays"), F.bool_or(head == "DOUBLE").alias("_double"),
        F.bool_or(head.isin("DECIMAL", "BIGINT")).alias("_exact"),
        F.coalesce(F.max(F.coalesce(precision - scale, digits)), F.lit(0)).alias("_whole"),
        F.coalesce(F.max(scale), F.lit(0)).alias("_scale"),
        F.coalesce(F.max(F.coalesce(precision, digits)), F.lit(0)).alias("_digits"))
    kind = head_type(F.col("_merged"))
    fits = F.col("_whole") + F.col("_scale") <= 38
    decimal = F.when((F.col("_scale") <= 9) & (F.col("_whole") <= 29), "decimal(38,9)").when(
        (F.col("_scale") <= 18) & (F.col("_whole") <= 20), "decimal(38,18)").when(
        fits, F.concat(F.lit("decimal(38,"), F.col("_scale").cast("string"), F.lit(")"))).otherwise("variant")
    floating = F.when(~F.col("_exact") | (F.col("_digits") <= DOUBLE_DIGITS), "double").otherwise("variant")
    spark_type = (F.when(F.col("_arrays") | ~kind.isin(*SCALAR_HEADS), "variant")
                  .when(kind.isin("DECIMAL", "DOUBLE", "FLOAT"), F.when(F.col("_double"), floating).otherwise(decimal))
                  .otherwise(F.lower("_merged")))
    return found.select(*keys, "property", F.when(F.col("_arrays"), "ARRAY").otherwise(kind).alias("variant_type"),
                        spark_type.alias("spark_type"))


def resource_columns(parsed: DataFrame) -> DataFrame:
    """(resource_type, property, variant_type, spark_type)."""
    p = properties(parsed.where(F.col("resource_type").isNotNull()), "doc", ["resource_type"])
    return _column_types(p, ["resource_type"])


def column_plan(columns: DataFrame, key: str) -> dict[str, list[tuple[str, str, str]]]:
    """Collect the (small) per-property plan, ordered by property name."""
    plan: dict[str, list[tuple[str, str, str]]] = {}
    for r in columns.orderBy(key, "property").collect():
        plan.setdefault(r[key], []).append((r["property"], r["variant_type"], r["spark_type"]))
    return plan


def shred(parsed: DataFrame, resource: str, cols: list[tuple[str, str, str]]) -> DataFrame:
    """Typed table of one resource (H6): filter + one cast per property.
    A value that does not fit its column type becomes NULL."""
    rows = parsed.where(F.col("resource_type") == resource)
    return rows.select(*[property_value("doc", p, t).alias(p) for p, _, t in cols])


def array_property(cols: list[tuple[str, str, str]], name: str) -> str | None:
    """Column gate (H7): the property matching ``name`` (case-insensitive)
    if it exists and holds arrays, else None."""
    for p, vt, _ in cols:
        if p.upper() == name.upper():
            return p if vt == "ARRAY" else None
    return None


def child_elements(resource_rows: DataFrame, parent_table: str, array_col: str,
                   source_col: str, id_col: str = "id") -> DataFrame:
    """One row per array element (H2); empty or NULL arrays, and values that
    are no arrays, give no row.  Resources without an id have a NULL parent."""
    elems = F.explode(F.try_variant_get(F.col(array_col), "$", "array<variant>"))
    parent = F.col(id_col).cast("string") if id_col in resource_rows.columns else F.lit(None).cast("string")
    return resource_rows.select(
        F.lit(parent_table).alias("PARENT_RESOURCE"),
        F.lit(source_col).alias("SOURCE_COL"),
        parent.alias("PARENT_ID"),
        elems.alias("element"))


def _is_object(element: str = "element") -> Column:
    return F.try_variant_get(F.col(element), "$", "map<string,variant>").isNotNull()


def element_properties(elements: DataFrame, keep: list[str] = ()) -> DataFrame:
    """(keep..., property, value) of array elements: the properties of object
    elements, and the element itself as ``value`` for primitive ones (H5).  An
    object's own ``value`` property shares that column."""
    objects = properties(elements.where(_is_object()), "element", list(keep))
    scalars = elements.where(~_is_object()).select(*keep, F.lit(PRIMITIVE_COLUMN).alias("property"),
                                                   F.col("element").alias("value"))
    return objects.unionByName(scalars)


def child_schema(elements: DataFrame) -> DataFrame:
    """(property, col_type) of the elements, after the three fixed parent
    columns (H4)."""
    fixed = elements.sparkSession.createDataFrame(
        [(c, "TEXT") for c in PARENT_COLUMNS], "property string, col_type string")
    props = element_properties(elements)
    found = props.select("property", type_name(F.col("value")).alias("col_type")).distinct()
    return fixed.unionByName(found)


def shred_children(elements: DataFrame, cols: list[tuple[str, str, str]]) -> DataFrame:
    def column(p: str, t: str) -> Column:
        own = property_value("element", p, t)
        if p == PRIMITIVE_COLUMN:
            own = F.when(_is_object(), own).otherwise(F.try_variant_get("element", "$", t))
        return own.alias(p)
    return elements.select(*PARENT_COLUMNS, *[column(p, t) for p, _, t in cols])


def child_columns(elements: DataFrame) -> list[tuple[str, str, str]]:
    props = element_properties(elements)
    return column_plan(_column_types(props.withColumn("_k", F.lit(0)), ["_k"]), "_k").get(0, [])


def child_table(resource_rows: DataFrame, resource: str, cols: list[tuple[str, str, str]],
                source_col: str, mapping: Mapping[str, Mapping[str, str]] = CHILD_TABLES,
                id_col: str = "id") -> tuple[str, DataFrame] | None:
    """Shredded child table for one mapped array column, or None when the
    column is missing or holds no array (H7, H8)."""
    parent = table_name(resource)
    target = mapping.get(parent, {}).get(source_col)
    prop = array_property(cols, source_col)
    if target is None or prop is None:
        return None
    elements = child_elements(resource_rows, parent, prop, source_col, id_col)
    return target, shred_children(elements, child_columns(elements))


@dataclass
class ResourcePlan:
    """Columns (property, variant type, Spark type) of a resource, and those of
    the elements of each property that holds arrays."""
    columns: list[tuple[str, str, str]] = field(default_factory=list)
    children: dict[str, list[tuple[str, str, str]]] = field(default_factory=dict)


def _node_type(node: Node) -> str | None:
    """The Spark type of a merged type; None if it hides what was merged (a
    conflict, or numbers that may have lost digits)."""
    if node.head in ("VARIANT", "DOUBLE", "FLOAT"):
        return None
    if node.head == "DECIMAL":
        precision, scale = node.size
        return exact_decimal(precision - scale, scale)
    return node.head.lower() if node.head in SCALAR_HEADS else "variant"


def _element_columns(element: Node) -> list[tuple[str, str, str]] | None:
    """The columns of array elements of a merged type; None if unsettled."""
    if element.head == "VOID":
        return [(PRIMITIVE_COLUMN, "VOID", "variant")]
    if element.head != "OBJECT":
        kind = _node_type(element)
        return None if kind is None else [(PRIMITIVE_COLUMN, element.head, kind)]
    out = [(p, n.head, _node_type(n)) for p, n in element.fields.items()]
    return None if any(t is None for _, _, t in out) else out


def document_plan(parsed: DataFrame, wanted: Mapping[str, Sequence[str]] | None = None) -> dict[str, ResourcePlan]:
    """The columns of every resource and of its array elements, from one
    aggregate over whole documents.

    What the merged types hide (conflicts, doubles beside decimals) is looked
    up in the values of those properties only.  ``wanted`` limits the elements
    looked at to some properties of a resource.
    """
    plan: dict[str, ResourcePlan] = {}
    open_columns: list[tuple[str, str]] = []
    open_elements: list[tuple[str, str]] = []

    def is_wanted(resource: str, prop: str) -> bool:
        return wanted is None or prop in wanted.get(resource, ())

    for resource, tree in document_trees(parsed).items():
        one = plan[resource] = ResourcePlan()
        for prop, node in tree.fields.items():
            kind = _node_type(node)
            one.columns.append((prop, node.head, kind or ""))
            if kind is None:
                open_columns.append((resource, prop))
            elif node.head == "ARRAY" and is_wanted(resource, prop):
                elements = _element_columns(node.element)
                if elements is None:
                    open_elements.append((resource, prop))
                else:
                    one.children[prop] = elements
    if open_columns:
        found = _settled(_values(parsed, open_columns))
        for resource, one in plan.items():
            one.columns = [(p, *found.get((resource, p), (vt, t))) for p, vt, t in one.columns]
        open_elements += [(r, p) for (r, p), (vt, _) in found.items() if vt == "ARRAY" and is_wanted(r, p)]
    if open_elements:
        arrays = _values(parsed, open_elements)
        elements = arrays.select("resource", F.col("property").alias("array"), F.explode(
            F.try_variant_get("value", "$", "array<variant>")).alias("element"))
        for (resource, array, prop), kinds in _settled(
                element_properties(elements, ["resource", "array"]), ["resource", "array"]).items():
            plan[resource].children.setdefault(array, []).append((prop, *kinds))
        for resource, array in open_elements:
            plan[resource].children.setdefault(array, []).sort()
    return plan


def _values(parsed: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(resource, property, value) of some properties of some resources."""
    cells = F.array(*[F.when(F.col("resource_type") == r, F.struct(
        F.lit(r).alias("resource"), F.lit(p).alias("property"), property_value("doc", p, "variant").alias("value")))
        for r, p in pairs])
    rows = parsed.where(F.col("resource_type").isin(*{r for r, _ in pairs}))
    return rows.select(F.explode(F.filter(cells, lambda x: x["value"].isNotNull())).alias("x")).select("x.*")


def _settled(props: DataFrame, keys: Sequence[str] = ("resource",)) -> dict[tuple, tuple[str, str]]:
    rows = _column_types(props, list(keys)).collect()  # bounded by the property names
    return {(*[r[k] for k in keys], r["property"]): (r["variant_type"], r["spark_type"]) for r in rows}


def path_schema(parsed: DataFrame) -> DataFrame:
    """(fhir_resource, path, col_type): the merged type of everything in the
    documents of a resource, at every depth, with array indexes normalised (X10)."""
    rows = [(r, path, TYPE_NAMES.get(head, head)) for r, tree in document_trees(parsed).items() for path, head in paths(tree)]
    return parsed.sparkSession.createDataFrame(rows, "fhir_resource string, path string, col_type string")


def arrays_named(plan: ResourcePlan, name: str) -> list[str]:
    """The properties of any spelling of ``name`` that hold arrays (H7)."""
    return [p for p, vt, _ in plan.columns if p.upper() == name.upper() and vt == "ARRAY"]


def document_elements(parsed: DataFrame, resource: str, prop: str, source_col: str) -> DataFrame:
    """One row per element of a resource's array property (H2), as of ``child_elements``."""
    rows = parsed.where(F.col("resource_type") == resource)
    return rows.select(
        F.lit(table_name(resource)).alias("PARENT_RESOURCE"), F.lit(source_col).alias("SOURCE_COL"),
        property_value("doc", "id", "string").alias("PARENT_ID"),
        F.explode(property_value("doc", prop, "array<variant>")).alias("element"))


def child_rows(parsed: DataFrame, plan: Mapping[str, ResourcePlan], resource: str, source_col: str) -> DataFrame | None:
    """The typed child rows of one array column, or None when no spelling of it
    holds an array (H7, H8)."""
    one = plan.get(resource, ResourcePlan())
    parts = [shred_children(document_elements(parsed, resource, p, source_col), one.children.get(p, []))
             for p in arrays_named(one, source_col)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    """An ingested table with the columns of all its batches."""
    return spark.read.option("mergeSchema", "true").parquet(path)


@dataclass
class Part:
    """Rows that go to a table: the columns in front, the typed properties, and where they come from."""
    table: str
    rows: DataFrame
    obj: str
    columns: list[tuple[str, str, str]]
    front: tuple[str, ...] = ()


def _parts(staged: DataFrame, mapping: Mapping[str, Mapping[str, str]]) -> list[Part]:
    trees = document_plan(staged)
    out = []
    for resource, plan in trees.items():
        table = table_name(resource)
        out.append(Part(table, staged.where(F.col("resource_type") == resource), "doc", plan.columns))
        for source_col, target in mapping.get(table, {}).items():
            for prop in arrays_named(plan, source_col):
                out.append(Part(target, document_elements(staged, resource, prop, source_col), "element",
                                plan.children.get(prop, []), PARENT_COLUMNS))
    return out


def _resolved(spark: SparkSession, path: str, part: Part, reserved: Sequence[str], batch: str) -> DataFrame:
    """The part's rows under the column names and types of the table's ledger."""
    names = ledger.resolve(spark, path, [(p, t, vt == "VOID") for p, vt, t in part.columns], reserved, batch)

    def column(entry: ledger.Entry) -> Column:
        own = property_value(part.obj, entry.property, entry.type)
        if part.obj == "element" and entry.property == PRIMITIVE_COLUMN:
            own = F.when(_is_object(), own).otherwise(F.try_variant_get("element", "$", entry.type))
        return own.alias(entry.column)
    return part.rows.select(*part.front, *[column(e) for e in names])


def _drop_stale(spark: SparkSession, root: str, batch: str, written: Mapping[str, str]) -> None:
    """Deletes what an earlier run of the batch left in tables that it no longer writes."""
    location = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = location.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(location):
        return
    escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(batch)
    for status in fs.listStatus(location):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("FHIR_") and name not in written:
            old = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), f"{BATCH_COLUMN}={escaped}")
            if fs.exists(old):
                fs.delete(old, True)


def bulk_ingest(docs: DataFrame, target_dir: str, mapping: Mapping[str, Mapping[str, str]] = CHILD_TABLES,
                doc_col: str = "file_row", batch_id: str | int = 0) -> dict[str, str]:
    """Parse, stage, shred and write every resource and mapped child table, and
    the rejected documents with the reason (N15).

    Returns {table name: path}.  The rows of batch ``batch_id`` replace those
    of an earlier run of the same batch, in every table; other batches stay.  Children come
    from this batch's documents only.  Tables that several resources or
    spellings share receive the union of their rows, by column name.  Each table
    has a ledger of its columns (``ledger.read``).
    """
    spark, root, batch = docs.sparkSession, target_dir.rstrip("/"), str(batch_id)
    parsed = parse_documents(docs, doc_col)
    folder = stage(parsed.withColumn("resource_type", F.coalesce("resource_type", F.lit(""))), "fhir-documents",
                   partition_by=["resource_type"])
    parts: dict[str, list[Part]] = {}
    for part in _parts(folder.where("resource_type <> ''"), mapping):
        parts.setdefault(part.table, []).append(part)
    bad = rejects(folder.withColumn("resource_type", F.nullif("resource_type", F.lit(""))), doc_col)
    rejected = bad.limit(1).count() > 0

    def write(name: str) -> tuple[str, str]:
        path = f"{root}/{name}"
        # a table that takes children keeps its parent columns free, whoever writes it
        target = any(name in t.values() for t in mapping.values())
        reserved = [BATCH_COLUMN, *(PARENT_COLUMNS if target else ()),
                    *(("reason", doc_col) if name == REJECTS_TABLE else ())]
        frames = [_resolved(spark, path, p, reserved, batch) for p in parts.get(name, [])]
        if name == REJECTS_TABLE and rejected:
            frames.append(bad)
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        (rows.withColumn(BATCH_COLUMN, F.lit(batch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH_COLUMN).parquet(path))
        return name, path

    # one write a table: they have different columns and run side by side
    with ThreadPoolExecutor(WRITERS) as pool:
        written = dict(pool.map(write, [*parts, *([REJECTS_TABLE] if rejected and REJECTS_TABLE not in parts else [])]))
    _drop_stale(spark, root, batch, written)
    discard(folder)
    return written


def comparable(df: DataFrame) -> DataFrame:
    """Presentation for value comparison: decimals as double, VARIANT as
    JSON text, array-valued VARIANT columns left out."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f.name).cast("double").alias(f.name))
        elif isinstance(f.dataType, T.VariantType):
            out.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)

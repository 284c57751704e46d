"""The schema ledger: which column of an ingested table holds which property.

Per table it keeps, for every column, the property as the source spelled it,
the type, and the first batch that had it.  Names are resolved by it: in the
tables, names that differ only in case are one name, and some names are taken
(the batch, a child's parent).  A property gets a column of its own spelling if
that name is free; otherwise, or if an earlier batch had another type, it gets
a name of its own (``name__2``, ``name__string``).  What a batch was given once,
every later batch gets again, so files of all batches can be read together.

A ledger is a list of small versions under ``<table>/_ledger``, each created
once: of two batches that add columns at the same time, the second starts over.
It is bounded by the property names.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from bedflow.sources import published

SCHEMA = "column string, property string, type string, first_batch string"


@dataclass(frozen=True)
class Entry:
    column: str
    property: str
    type: str
    first_batch: str


def holds(column_type: str, value_type: str) -> bool:
    """Whether every value of a type keeps all its digits in a column of another."""
    return column_type == value_type or (value_type == "bigint" and column_type in ("decimal(38,9)", "decimal(38,18)"))


def kind(type_name: str) -> str:
    return type_name.split("(")[0].split("<")[0]


def assign(entries: list[Entry], columns: Sequence[tuple[str, str, bool]], reserved: Iterable[str],
           batch: str) -> tuple[list[Entry], list[Entry]]:
    """(an entry for each of ``columns``, the entries that are new).
    ``columns`` are (property, type, known only as null)."""
    taken = {e.column.lower() for e in entries} | {r.lower() for r in reserved}
    known: dict[str, list[Entry]] = {}
    for e in entries:
        known.setdefault(e.property, []).append(e)
    out, new = [], []
    for name, type_name, only_null in columns:
        mine = known.get(name, [])
        fitting = [e for e in mine if e.type == type_name] or [e for e in mine if holds(e.type, type_name)]
        if only_null and mine:
            fitting = mine
        if fitting:
            out.append(fitting[0])
            continue
        stem = name or "_"
        wanted = stem if not mine else f"{stem}__{kind(type_name)}"
        column, number = wanted, 2
        while column.lower() in taken:
            column, number = f"{wanted}__{number}", number + 1
        entry = Entry(column, name, type_name, batch)
        taken.add(column.lower())
        known.setdefault(name, []).append(entry)
        out.append(entry)
        new.append(entry)
    return out, new


def _folder(path: str) -> str:
    return f"{path.rstrip('/')}/_ledger"


def entries(spark: SparkSession, path: str) -> tuple[int, list[Entry]]:
    """(version, entries) of a table's ledger; version 0 without one."""
    found = published.versions(spark, _folder(path))
    if not found:
        return 0, []
    text = published.read_text(spark, published.manifest_path(_folder(path), found[-1]))
    return found[-1], [Entry(**e) for e in json.loads(text)]


def resolve(spark: SparkSession, path: str, columns: Sequence[tuple[str, str, bool]], reserved: Iterable[str],
            batch: str, tries: int = 20) -> list[Entry]:
    """An entry for each of ``columns``, written to the table's ledger if new."""
    reserved = list(reserved)
    for _ in range(tries):
        version, have = entries(spark, path)
        out, new = assign(have, columns, reserved, batch)
        if not new:
            return out
        text = json.dumps([asdict(e) for e in [*have, *new]], indent=1)
        if published.create_once(spark, published.manifest_path(_folder(path), version + 1), text):
            return out
    raise published.Conflict(f"the ledger of {path} was changed by others {tries} times")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(column, property, type, first_batch) of a table."""
    return spark.createDataFrame([(e.column, e.property, e.type, e.first_batch) for e in entries(spark, path)[1]], SCHEMA)

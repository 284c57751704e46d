"""Every registered query against its DuckDB oracle (literal original SQL
shape) on the sf0.01 fixture: same columns, same rows as a multiset."""
import datetime as dt
import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from bedflow import oracle
from bedflow.plans.catalog import QUERIES
from tests.conftest import SF01

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF01}/{t}.parquet'")
    return con


def _norm(df: pd.DataFrame):
    df = df[sorted(df.columns)]
    out = []
    for r in df.itertuples(index=False):
        vals = []
        for v in r:
            if isinstance(v, (pd.Timestamp, dt.date)):
                v = pd.Timestamp(v).isoformat()
            if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)):
                vals.append(None)
            elif isinstance(v, float):
                vals.append(repr(v))
            else:
                vals.append(str(v))
        out.append(tuple(vals))
    return sorted(out, key=lambda x: tuple("" if v is None else v for v in x))


@pytest.mark.parametrize("name", sorted(oracle.queries()))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF01).toPandas()
    want = duck.execute(oracle.queries()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _norm(got) == _norm(want)


def test_every_query_has_oracle_or_is_rows_only():
    rows_only = set(QUERIES) - set(oracle.queries())
    assert rows_only == {"los_classifier", "classification_report"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 70  # 31 backfill + 39 future rows at sf0.001
    assert df.columns[0] == "model_source" and len(df.columns) == 15

"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import hashlib
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tributary.plans.catalog import QUERIES
from tributary.plans.fixtures import TABLES

from .conftest import SF_SMALL


def _norm(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (bytes, bytearray)):
        return hashlib.md5(bytes(v)).hexdigest()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


# Spark simple type -> the DuckDB type the oracle must produce.
TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
            "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]"}


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) & set(queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = queries()[key](spark, SF_SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(oracle_sql()[key])
    want = _rows(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert TYPE_MAP.get(t, t) == duck_types[f.name], (f.name, t, duck_types[f.name])
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "partition_value" in df.columns

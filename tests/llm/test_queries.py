"""The queries that have SQL against it, on the smallest tables."""

import duckdb
import pytest

from tributary.llm.oracles import ORACLES
from tributary.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel, df = con.sql(ORACLES[key]), QUERIES[key](spark, SF)
    names = sorted(df.columns)
    assert names == sorted(rel.columns)
    want = sorted((tuple(r[rel.columns.index(n)] for n in names) for r in rel.fetchall()), key=str)
    assert sorted((tuple(r[n] for n in names) for r in df.collect()), key=str) == want

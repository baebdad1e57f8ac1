"""Operators with SQL against DuckDB, the thin queries against their contracts."""

import duckdb
import pytest

from cohortmine.llm.catalog import ORACLE_SQL, QUERIES


def _norm(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = QUERIES[name](spark, sf)
    res = con.execute(ORACLE_SQL[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    got = sorted((tuple(_norm(r[c]) for c in sorted(cols)) for r in df.collect()), key=repr)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted((tuple(_norm(r[i]) for i in order) for r in res.fetchall()), key=repr)
    assert got == want


def test_one_query_an_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in QUERIES)
    assert numbers == list(range(1, 14))

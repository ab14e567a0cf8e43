"""Queries with SQL give the same rows in both engines; the others are held against brute force in the other modules."""

import duckdb
import pytest

from tarmac.llm.queries import ORACLE, QUERIES

TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    df, want = QUERIES[name](spark, folder), con.sql(ORACLE[name])
    assert {c: TYPES[t] for c, t in df.dtypes} == dict(zip(want.columns, map(str, want.types)))
    names = sorted(df.columns)
    got = sorted(repr([r[c] for c in names]) for r in df.toArrow().to_pylist())
    assert got == sorted(repr([r[c] for c in names]) for r in want.to_arrow_table().to_pylist())


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))

"""Every registered query with SQL gives the same rows in both engines; the others give rows."""

import duckdb
import pytest

from tarmac.contract.registry import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SLOW: set[str] = set()
TYPES = {
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "int": "INTEGER",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "tinyint": "TINYINT",
}


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def as_rows(table):
    names = sorted(table.column_names)
    return sorted(repr(tuple(r[n] for n in names)) for r in table.to_pylist())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, folder, duck, name):
    df = QUERIES[name](spark, folder)
    want = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    sql_types = dict(zip(want.columns, map(str, want.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == sql_types
    assert as_rows(df.toArrow()) == as_rows(want.to_arrow_table())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)

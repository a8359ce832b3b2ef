"""Every registered query against its SQL on the small tables."""

from pathlib import Path

import duckdb
import pytest

from threadloom.registry import ORACLES, QUERIES

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("\0" if r[i] is None else str(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    want = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    assert got == canonical(want.columns, want.fetchall())
    assert got, "a query without rows shows nothing"

"""Every query against its SQL, on the smallest test data."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from sondar.queries import problems, reference, reference_sql

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for p in DATA.iterdir():
        c.sql(f"create view {p.stem} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", [*problems.QUERIES, *reference.QUERIES])
def test_query(spark, con, name):
    from tools.compare_oracle import rows

    df = entry.queries()[name](spark, str(DATA))
    mine = rows(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert mine
        return
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert mine == rows(names, cur.fetchall())


def test_every_query_has_sql_or_a_reason():
    known = {"stats_percentiles"}  # approximate: no equal in SQL
    assert set(reference.QUERIES) - set(reference_sql.SQL) == known


def test_flagship(spark):
    assert entry.entry(spark).count() > 0

"""Every registered query against its SQL statement on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import oracle
from overlake import workloads
from tests.conftest import SF

NAMES = sorted(workloads.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        c.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return c


def test_every_query_has_a_statement():
    assert set(oracle.statements()) == set(NAMES)
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    expected = con.sql(entry.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(expected.columns) == columns
    at = [expected.columns.index(c) for c in columns]
    ours = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    theirs = sorted(repr(tuple(r[i] for i in at)) for r in expected.fetchall())
    assert ours == theirs


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "team"

"""Every registered query against DuckDB on the same tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from tripmart.checks import queries as registered

SF_DIR = os.environ.get("TRIPMART_SF_DIR", "/root/testdata/sf0.01")
QUERIES = entry_points.queries()
ORACLE = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        tuple("null" if row[i] is None or row[i] != row[i] else repr(row[i]) for i in order) for row in rows
    )


def test_every_query_has_sql():
    assert registered.queries().keys() <= ORACLE.keys() <= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck, name):
    got = QUERIES[name](spark, SF_DIR)
    want = duck.execute(ORACLE[name])
    want_columns = [column[0] for column in want.description]
    assert sorted(got.columns) == sorted(want_columns)
    got_rows, want_rows = got.collect(), want.fetchall()
    assert len(got_rows) > 0
    assert len(got_rows) == len(want_rows)
    assert canonical(got.columns, got_rows) == canonical(want_columns, want_rows)


def test_entry_has_rows(spark):
    rows = entry_points.entry(spark)
    assert rows.count() > 0
    assert len(rows.columns) == 27

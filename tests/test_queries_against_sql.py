"""Every registered query against its SQL on the same tables."""

import os
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from orderstrata.samples.queries import QUERIES
from orderstrata.samples.sql import ORACLE_SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


def test_each_query_has_sql():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLE_SQL[name])
    expected_columns = [c[0] for c in expected.description]
    expected_rows = expected.fetchall()
    assert sorted(frame.columns) == sorted(expected_columns)
    actual = _sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert expected_rows, "an empty result checks nothing"
    assert actual == _sorted_rows(expected_columns, expected_rows)


def test_flagship(spark):
    rows = entry(spark).collect()
    years = [row.OrderYear for row in rows]
    assert years and years == sorted(set(years))

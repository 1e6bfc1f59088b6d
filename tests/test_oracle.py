"""Every query against its SQL in DuckDB, value by value."""

from __future__ import annotations

import itertools
import os
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from zonalake import registry

DEFAULT_DIR = "/root/testdata/sf0.01"
SF_DIR = os.environ.get("TEST_SF_DIR", DEFAULT_DIR)
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def _kind(value):
    if value is None:
        return None
    if isinstance(value, Decimal):
        return Decimal
    return type(value)


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((_kind(row[i]), row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.execute(ORACLES[name])
    names = [column[0] for column in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    expected = _bag(names, theirs.fetchall())
    actual = _bag(ours.columns, [tuple(row) for row in ours.collect()])
    # A page past the end of the smallest tables may be empty.
    assert expected or SF_DIR != DEFAULT_DIR
    assert actual == expected


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_sort_lies_below_an_aggregate(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    depths = [(len(line) - len(line.lstrip(" :+-")), line.lstrip(" :+-")) for line in plan.split("\n")]
    for at, (depth, node) in enumerate(depths):
        if node.startswith("Aggregate"):
            below = itertools.takewhile(lambda x: x[0] > depth, depths[at + 1 :])
            assert not any(line.startswith("Sort") for _, line in below)


def test_driver_has_every_query():
    assert QUERIES.keys() <= driver.queries().keys()
    assert ORACLES.keys() <= driver.oracle_sql().keys()


def test_entry(spark):
    assert driver.entry(spark).count() > 0

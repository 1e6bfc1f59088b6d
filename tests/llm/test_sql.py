"""The text queries that SQL can express, against DuckDB."""

from __future__ import annotations

import duckdb
import pytest

from tests.test_oracle import SF_DIR, _bag
from zonalake.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_text_query_matches_sql(spark, name):
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
        theirs = duck.execute(queries.oracle_sql()[name])
        names = [column[0] for column in theirs.description]
        expected = _bag(names, theirs.fetchall())
    ours = queries.queries()[name](spark, SF_DIR)
    assert sorted(ours.columns) == sorted(names)
    assert _bag(ours.columns, [tuple(row) for row in ours.collect()]) == expected

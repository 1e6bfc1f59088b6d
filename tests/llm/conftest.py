"""Helpers of the text operator tests."""

from __future__ import annotations

import pytest

from zonalake.llm.shipping import ship_package

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A frame with the columns of `documents` from (doc_id, text) or (doc_id, text, source) rows."""
    ship_package(spark)

    def build(rows, extra: bool = False):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] else None) for r in rows
        ]
        frame = spark.createDataFrame(full, DOCUMENT).repartition(3)
        if extra:  # names that an operator might use itself
            for name in ("size", "id", "hash", "n", "node", "key", "target", "score", "rank", "host"):
                frame = frame.selectExpr("*", f"'x' AS {name}")
        return frame

    return build

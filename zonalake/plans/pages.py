"""Filtered, ordered pages of the gold marts."""

from __future__ import annotations

import base64
import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from zonalake.fixed_values import DEFAULT_PAGE_SIZE, MAX_POLLUTION_PAGE, MAX_TRAFFIC_PAGE
from zonalake.schemas import DATE_KEYS, POLLUTION_MART, TRAFFIC_MART, TRAFFIC_POLLUTION_MART


def text_equals(df: DataFrame, column: str, value: str | None, collation: str | None) -> DataFrame:
    """Rows whose column equals `value`; no filter when it is None or empty. A collation such as
    `UNICODE_CI_AI` makes the comparison ignore case and accents."""
    if not value:
        return df
    own = F.col(column)
    return df.filter((own if collation is None else F.collate(own, collation)) == value)


POLLUTION_ORDER = ("avg_pollution", "zone", *DATE_KEYS)
TRAFFIC_ORDER = ("avg_traffic", "zone", "hour", *DATE_KEYS)


def cursor_of(row: Row, order: Sequence[str]) -> str:
    """A token of a page's last row, from which the next page goes on."""
    return base64.urlsafe_b64encode(json.dumps([row[name] for name in order]).encode()).decode()


def _seek(order: Sequence[str], cursor: str) -> Column:
    """Rows that stand behind the cursor's: the first column falls, with NULL last, the others rise,
    with NULL first. Comparisons with literals only, so that they reach the scan."""
    try:
        values = json.loads(base64.urlsafe_b64decode(cursor.encode()))
    except ValueError as error:
        raise ValueError("not a cursor of a page") from error
    if not isinstance(values, list) or len(values) != len(order):
        raise ValueError("not a cursor of this page")
    behind, same = F.lit(False), F.lit(True)
    for at, (name, value) in enumerate(zip(order, values, strict=True)):
        own = F.col(name)
        if at == 0:
            later = F.lit(False) if value is None else (own < value) | own.isNull()
        else:
            later = own.isNotNull() if value is None else own > value
        behind = behind | (same & later)
        same = same & own.eqNullSafe(F.lit(value))
    return behind


def _page(
    df: DataFrame, order: Sequence[str], page: int, limit: int, most: int, after: str | None
) -> DataFrame:
    """By number, which sorts all rows up to the page's last; or the rows behind a cursor, which sorts
    the page's own however far it lies."""
    if page < 1:
        raise ValueError("page must be 1 or more")
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}")
    if after is not None:
        if page != 1:
            raise ValueError("a page has a number or a cursor")
        return df.filter(_seek(order, after)).orderBy(F.desc(order[0]), *order[1:]).limit(limit)
    return df.orderBy(F.desc(order[0]), *order[1:]).offset((page - 1) * limit).limit(limit)


def pollution_page(
    mart: DataFrame,
    page: int = 1,
    limit: int = DEFAULT_PAGE_SIZE,
    zone: str | None = None,
    collation: str | None = None,
    after: str | None = None,
) -> DataFrame:
    """Most polluted first. All group keys break ties, so pages never overlap."""
    rows = text_equals(mart, "zone", zone, collation).select(*POLLUTION_MART)
    return _page(rows, POLLUTION_ORDER, page, limit, MAX_POLLUTION_PAGE, after)


def traffic_page(
    mart: DataFrame,
    page: int = 1,
    limit: int = DEFAULT_PAGE_SIZE,
    zone: str | None = None,
    hour: int | None = None,
    collation: str | None = None,
    after: str | None = None,
) -> DataFrame:
    """Most congested first."""
    if hour is not None and not 0 <= hour <= 23:
        raise ValueError("hour must be between 0 and 23")
    rows = text_equals(mart, "zone", zone, collation).select(*TRAFFIC_MART)
    if hour is not None:
        rows = rows.filter(F.col("hour") == hour)
    return _page(rows, TRAFFIC_ORDER, page, limit, MAX_TRAFFIC_PAGE, after)


def traffic_pollution_page(
    mart: DataFrame,
    page: int = 1,
    limit: int = DEFAULT_PAGE_SIZE,
    zone: str | None = None,
    traffic_level: str | None = None,
    collation: str | None = None,
    after: str | None = None,
) -> DataFrame:
    """Most congested first, with pollution, weather and level."""
    rows = text_equals(mart, "zone", zone, collation)
    rows = text_equals(rows, "traffic_level", traffic_level, collation)
    return _page(
        rows.select(*TRAFFIC_POLLUTION_MART), TRAFFIC_ORDER, page, limit, MAX_TRAFFIC_PAGE, after
    )


def page_reply(rows: DataFrame, page: int, limit: int) -> dict[str, Any]:
    """The page as a reply. `total` is the number of rows on this page. `limit` rows are
    collected at most."""
    data = [row.asDict() for row in rows.limit(limit).collect()]
    return {"page": page, "limit": limit, "total": len(data), "data": data}


def cursor_reply(rows: DataFrame, order: Sequence[str], limit: int) -> dict[str, Any]:
    """The page with the cursor of the next one, or None behind the last. `limit` rows are collected
    at most."""
    found = rows.limit(limit).collect()
    following = cursor_of(found[-1], order) if len(found) == limit else None
    return {"limit": limit, "next": following, "data": [row.asDict() for row in found]}

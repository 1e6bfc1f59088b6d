"""Pages, summaries and dashboard series over small marts."""

from __future__ import annotations

import random
import re

import pytest
from fixtures import bag
from pyspark.sql import functions as F

from zonalake.fixed_values import MAX_POLLUTION_PAGE, MAX_TRAFFIC_PAGE, ZONE_ORDER
from zonalake.plans import dashboard, pages, summaries
from zonalake.schemas import DATE_KEYS

POLLUTION = "zone string, year int, month int, day int, avg_pollution double, max_pollution double, avg_aqi double"
TRAFFIC = (
    "zone string, hour int, year int, month int, day int, avg_traffic double, max_traffic double"
)
BOTH = (
    "zone string, hour int, year int, month int, day int, avg_pollution double, avg_traffic double,"
    "avg_temperature double, avg_humidity double, traffic_level string"
)


@pytest.fixture(scope="module")
def pollution(spark):
    rows = [
        ("nation", 2025, 4, 1, 10.25, 50.0, 3.0),
        ("nation", 2025, 4, 2, 10.0, 60.0, 4.0),
        ("chatelet", 2025, 4, 1, 30.0, 40.0, 5.0),
        ("saint_michel", 2025, 4, 1, 30.0, 45.0, 6.0),
        ("montparnasse", 2025, 4, 1, 10.1, 20.0, 7.0),
        ("elsewhere", 2025, 4, 1, 99.0, 99.0, 9.0),
    ]
    return spark.createDataFrame(rows, POLLUTION)


@pytest.fixture(scope="module")
def traffic(spark):
    rows = [
        ("nation", 0, 2025, 4, 1, 100.0, 110.0),
        ("nation", 7, 2025, 4, 1, 900.0, 950.0),
        ("nation", 7, 2025, 4, 2, 901.0, 960.0),
        ("chatelet", 8, 2025, 4, 1, 900.5, 990.0),
        ("chatelet", 23, 2025, 4, 1, 50.04, 51.0),
        ("elsewhere", 7, 2025, 4, 1, 5000.0, 6000.0),
    ]
    return spark.createDataFrame(rows, TRAFFIC)


@pytest.fixture(scope="module")
def both(spark):
    rows = [
        ("nation", 0, 2025, 4, 1, 10.0, 100.0, 5.0, 10.0, "Low Traffic"),
        ("nation", 7, 2025, 4, 1, 20.0, 900.0, 7.0, 20.0, "Medium Traffic"),
        ("chatelet", 7, 2025, 4, 1, 40.0, 1500.0, 9.0, 90.0, "High Traffic"),
        ("chatelet", 8, 2025, 4, 1, None, None, 9.0, 90.0, "High Traffic"),
    ]
    return spark.createDataFrame(rows, BOTH)


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_pages_are_disjoint_and_complete(pollution):
    whole = rows(pages.pollution_page(pollution, limit=100))
    parts = [r for page in (1, 2, 3) for r in rows(pages.pollution_page(pollution, page, 2))]
    assert parts == whole and len(whole) == 6
    assert [r[0] for r in whole[:3]] == ["elsewhere", "chatelet", "saint_michel"]
    assert rows(pages.pollution_page(pollution, page=4, limit=2)) == []


def test_page_bounds(pollution, traffic, both):
    for page, limit in ((0, 5), (1, 0), (1, MAX_POLLUTION_PAGE + 1)):
        with pytest.raises(ValueError):
            pages.pollution_page(pollution, page, limit)
    pages.traffic_page(traffic, limit=MAX_TRAFFIC_PAGE)
    for kwargs in ({"limit": MAX_TRAFFIC_PAGE + 1}, {"hour": 24}, {"hour": -1}):
        with pytest.raises(ValueError):
            pages.traffic_page(traffic, **kwargs)
    with pytest.raises(ValueError):
        pages.traffic_pollution_page(both, limit=MAX_TRAFFIC_PAGE + 1)


def test_page_filters(traffic, both):
    assert pages.traffic_page(traffic, zone="").count() == 6
    assert [r[0] for r in rows(pages.traffic_page(traffic, hour=0))] == ["nation"]
    assert pages.traffic_page(traffic, zone="nation", hour=7).count() == 2
    assert pages.traffic_page(traffic, zone="NATION").count() == 0
    assert pages.traffic_page(traffic, zone="NÀTION", collation="UNICODE_CI_AI").count() == 3
    got = rows(pages.traffic_pollution_page(both, traffic_level="High Traffic"))
    assert [r[1] for r in got] == [7, 8]
    assert pages.traffic_pollution_page(both, zone="chatelet", traffic_level="").count() == 2


def test_page_plan_keeps_only_the_page(traffic):
    page = pages.traffic_page(traffic, page=2, limit=2)
    assert "TakeOrderedAndProject" in page._jdf.queryExecution().executedPlan().toString()


def test_page_reply(pollution):
    reply = pages.page_reply(pages.pollution_page(pollution, 2, 4), 2, 4)
    assert (reply["page"], reply["limit"], reply["total"]) == (2, 4, 2)
    assert reply["data"][0] == {
        "zone": "montparnasse",
        "year": 2025,
        "month": 4,
        "day": 1,
        "avg_pollution": 10.1,
        "max_pollution": 20.0,
        "avg_aqi": 7.0,
    }


def test_summaries(pollution, traffic, both):
    assert rows(summaries.pollution_summary(pollution))[:2] == [
        ("elsewhere", 99.0, 99.0, 9.0),
        ("chatelet", 30.0, 40.0, 5.0),
    ]
    assert ("nation", 10.13, 60.0, 3.5) in rows(summaries.pollution_summary(pollution))
    assert [r[0] for r in rows(summaries.traffic_by_hour(traffic))] == [0, 7, 8, 23]
    assert rows(summaries.traffic_by_zone(traffic))[-1] == ("chatelet", 475.27, 990.0)
    assert rows(summaries.traffic_heatmap(traffic))[0] == ("chatelet", 8, 900.5)
    assert rows(summaries.traffic_pollution_summary(both))[0] == (
        "chatelet",
        1500.0,
        40.0,
        9.0,
        90.0,
    )
    levels = rows(summaries.traffic_pollution_by_level(both))
    assert levels[0] == ("High Traffic", 2, 40.0, 9.0, 90.0)
    assert [r[0] for r in levels] == ["High Traffic", "Medium Traffic", "Low Traffic"]


def test_correlation(both):
    got = {r.zone: (r["count"], r.correlation) for r in summaries.traffic_pollution_corr(both).collect()}
    assert got["nation"] == (2, pytest.approx(1.0))
    assert got[None][0] == 4 and 0 < got[None][1] <= 1


def test_dashboard_filters(pollution, traffic, both):
    assert dashboard.filter_pollution(pollution).count() == 5
    assert dashboard.filter_pollution(pollution, []).count() == 0
    hours = dashboard.filter_traffic(traffic, ZONE_ORDER, (0, 7))
    assert sorted(r.hour for r in hours.collect()) == [0, 7, 7]
    levels = dashboard.filter_traffic_pollution(both, levels=["Low Traffic"])
    assert levels.count() == 1


def test_dashboard_series(pollution, traffic, both):
    assert rows(dashboard.pollution_by_zone(dashboard.filter_pollution(pollution)))[2:] == [
        ("montparnasse", 10.1, 20.0, 7.0),
        ("nation", 10.1, 60.0, 3.5),
    ]
    selected = dashboard.filter_traffic(traffic)
    assert rows(dashboard.traffic_by_zone(selected))[0] == ("nation", 633.7, 960.0)
    assert rows(dashboard.traffic_by_hour_zone(selected))[1] == (7, "nation", 900.5)
    assert rows(dashboard.pollution_by_level(both))[0] == ("High Traffic", 40.0, 1)
    assert [r[0] for r in rows(dashboard.level_bars(both))] == ["High", "Low", "Medium"]
    assert rows(dashboard.env_conditions(both)) == [("Chatelet", 9.0, 90.0), ("Nation", 6.0, 15.0)]
    sizes = {r.zone: r.bubble_size for r in dashboard.traffic_pollution_bubbles(both).collect()}
    assert sizes == {"Chatelet": 63.0, "Nation": 20.0}


def test_pivot_follows_the_zone_order_and_fills_gaps(traffic):
    pivot = dashboard.heatmap_pivot(traffic)
    assert pivot.columns == ["zone"] + [f"{h:02d}h" for h in range(24)]
    got = [row.asDict() for row in pivot.collect()]
    assert [row["zone"] for row in got] == ["Chatelet", "Nation"]
    assert (got[0]["08h"], got[0]["23h"], got[0]["00h"]) == (900.5, 50.0, 0.0)
    narrow = dashboard.heatmap_pivot(traffic, ["nation"], (6, 8))
    assert narrow.columns == ["zone", "06h", "07h", "08h"]
    assert rows(narrow) == [("Nation", 0.0, 900.5, 0.0)]


def test_shares(pollution):
    shares = rows(dashboard.pollution_share(dashboard.filter_pollution(pollution)))
    assert [s[0] for s in shares] == ["Chatelet", "Saint Michel", "Montparnasse", "Nation"]
    assert [s[2] for s in shares] == [37.4, 37.4, 12.6, 12.6]


def test_key_figures_and_their_ties(pollution, traffic):
    board = dashboard.kpi_board(
        dashboard.filter_pollution(pollution), dashboard.filter_traffic(traffic)
    )
    assert rows(board) == [("Chatelet", "Nation", "07h", 20.1, "Nation")]


def test_key_figures_of_nothing(pollution, traffic):
    board = dashboard.kpi_board(
        dashboard.filter_pollution(pollution, []), dashboard.filter_traffic(traffic, [])
    )
    assert rows(board) == [("—", "—", "—", 0.0, "—")]


def test_bags_ignore_order(traffic):
    assert bag(traffic) == bag(traffic.orderBy("avg_traffic"))


def test_pages_by_cursor_are_the_whole_order(spark):
    """With NULLs and ties in every column, pages by cursor concatenate to the full order."""
    draw, nan = random.Random(4), float("nan")  # one object, so that equal rows go from the set
    rows = [
        (draw.choice(["a", "b", None]), draw.choice([0, 7, None]), 2025, 4, draw.choice([1, 2, None]),
         draw.choice([1.5, 2.5, nan, None]), 0.0)
        for _ in range(60)
    ]
    mart = spark.createDataFrame(sorted(set(rows), key=repr), TRAFFIC)
    whole = mart.orderBy(F.desc("avg_traffic"), "zone", "hour", *DATE_KEYS).collect()
    found, after = [], None
    while True:
        reply = pages.cursor_reply(pages.traffic_page(mart, limit=7, after=after), pages.TRAFFIC_ORDER, 7)
        found += reply["data"]
        after = reply["next"]
        if after is None:
            break
    assert repr(found) == repr([row.asDict() for row in whole])


def test_page_by_cursor_has_no_offset_and_reaches_the_scan(spark, pollution, tmp_path):
    pollution.write.parquet(f"{tmp_path}/p")
    stored = spark.read.parquet(f"{tmp_path}/p")
    token = pages.cursor_reply(pages.pollution_page(stored, limit=2), pages.POLLUTION_ORDER, 2)["next"]
    page = pages.pollution_page(stored, limit=2, after=token)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "Offset" not in plan and "TakeOrderedAndProject" in plan
    assert "LessThan(avg_pollution" in re.search(r"PushedFilters: \[(.*)\]", plan).group(1)
    assert rows(page) == rows(pages.pollution_page(pollution, 2, 2))
    for wrong in ("x", token[:-8], pages.cursor_of({"a": 1}, ["a"])):
        with pytest.raises(ValueError, match="cursor"):
            pages.pollution_page(stored, after=wrong)
    with pytest.raises(ValueError, match="number or a cursor"):
        pages.pollution_page(stored, page=2, after=token)

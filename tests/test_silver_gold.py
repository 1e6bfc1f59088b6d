"""The joined rows, and the marts from cells against the marts from joined rows."""

from __future__ import annotations

import math
import random

import pytest
from fixtures import bag, silver_air, silver_traffic
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonalake.functions import exact_sum
from zonalake.operators.cells import (
    air_cells,
    cells_of,
    cells_of_silver,
    merge_traffic_cells,
    pair_cells,
    traffic_cells,
)
from zonalake.operators.pairing import (
    SMALLEST_BLOCK,
    block_size,
    join_keys,
    plain_join,
    silver_join,
    task_count,
    with_blocks,
)
from zonalake.operators.rolling import rolling_by_hour, rolling_over_rows
from zonalake.plans import gold
from zonalake.sinks import silver_view_sql

AIR = [
    ("a", 7, 10.0, 1, 5.0, 50.0, 1),
    ("a", 7, 20.0, 2, 6.0, 51.0, 1),
    ("a", 7, 30.0, 3, 7.0, 52.0, 2),
    ("a", 9, 70.0, 4, 8.0, 53.0, 1),
    ("b", 7, 1.0, 5, 9.0, 54.0, 1),
    ("only_air", 7, 9.0, 5, 9.0, 54.0, 1),
    (None, 7, 9.0, 5, 9.0, 54.0, 1),
    ("a", None, 9.0, 5, 9.0, 54.0, 1),
]
TRAFFIC = [
    ("a", 7, 100.0),
    ("a", 7, 300.0),
    ("a", 9, 1000.0),
    ("b", 7, 500.0),
    ("b", 7, 499.98),
    ("b", 7, 500.0),
    ("only_traffic", 7, 5.0),
    (None, 7, 5.0),
    ("a", None, 5.0),
]


@pytest.fixture()
def sides(spark):
    return silver_air(spark, AIR), silver_traffic(spark, TRAFFIC)


def test_join_pairs_rows_of_a_zone_and_hour(sides):
    joined = silver_join(*sides)
    counts = {(r.zone, r.hour): r["count"] for r in joined.groupBy("zone", "hour").count().collect()}
    assert counts == {("a", 7): 6, ("a", 9): 1, ("b", 7): 3}
    assert joined.columns == [
        "zone",
        "hour",
        "pollution_value",
        "air_quality_index",
        "temperature",
        "humidity",
        "year",
        "month",
        "day",
        "debit_horaire",
        "rolling_avg_pollution",
    ]


def test_rolling_is_cumulative_over_hours(sides):
    means = {(r.zone, r.hour): r.rolling_avg_pollution for r in silver_join(*sides).collect()}
    assert means == {("a", 7): 20.0, ("a", 9): (6 * 20.0 + 70.0) / 7, ("b", 7): 1.0}


def test_grid_join_equals_plain_join(spark):
    """One zone and hour holds most rows on both sides, half of them copies of one row."""
    air = [("hot", 7, float(i % 50), i % 9, 1.0, 2.0, 1 + i % 3) for i in range(300)]
    air += [("hot", 7, 1.0, 1, 1.0, 2.0, 1)] * 300 + AIR
    traffic = [("hot", 7, float(i)) for i in range(100)] + [("hot", 7, 1.0)] * 100 + TRAFFIC
    air, traffic = silver_air(spark, air), silver_traffic(spark, traffic)
    blocks = with_blocks(join_keys(air, traffic), 1000)
    keys = {(r.zone, r.hour): r for r in blocks.collect()}
    assert keys["hot", 7].air_blocks > 10 and keys["hot", 7].traffic_blocks > 5
    assert keys["b", 7].air_blocks == keys["b", 7].traffic_blocks == 1
    grid = silver_join(air, traffic, pairs_per_block=1000)
    plain = rolling_over_rows(plain_join(air, traffic))
    rounding = F.round("rolling_avg_pollution", 9)
    assert grid.count() == 600 * 200 + 10
    both = [
        df.withColumn("rolling_avg_pollution", rounding).groupBy(*plain.columns).count()
        for df in (grid, plain)
    ]
    assert both[0].exceptAll(both[1]).count() == 0
    assert both[1].exceptAll(both[0]).count() == 0


def test_grid_spreads_copies_of_one_row(spark):
    """All rows of both sides are equal, and still no block is far over the budget."""
    air = silver_air(spark, [("hot", 7, 1.0, 1, 1.0, 2.0, 1)] * 2000)
    traffic = silver_traffic(spark, [("hot", 7, 5.0)] * 1000)
    joined = silver_join(air, traffic, pairs_per_block=10_000)
    assert joined.count() == 2000 * 1000
    sizes = joined.groupBy(F.spark_partition_id()).count().select(F.max("count")).first()[0]
    assert sizes < 2000 * 1000 / 4


def test_grid_placement_follows_content(spark):
    """Shuffled input in another order gives the same rows per task."""
    rows = [("hot", 7, float(i % 40), i % 9, 1.0, 2.0, 1) for i in range(400)]
    traffic = silver_traffic(spark, [("hot", 7, float(i % 70)) for i in range(150)])

    def per_task(order):
        joined = silver_join(silver_air(spark, order).repartition(5), traffic, 1000)
        return bag(joined.groupBy(F.spark_partition_id().alias("p")).count())

    assert per_task(rows) == per_task(rows[::-1])


def test_grid_blocks_stay_under_the_budget(spark):
    air = silver_air(spark, [("hot", 7, 1.0, 1, 1.0, 2.0, 1)] * 900)
    for n_traffic in (1, 10, 500):
        traffic = silver_traffic(spark, [("hot", 7, 1.0)] * n_traffic)
        key = with_blocks(join_keys(air, traffic), 400).first()
        side = math.ceil(900 / key.air_blocks) * math.ceil(n_traffic / key.traffic_blocks)
        assert side <= 2 * 400


def test_task_count_and_block_size():
    million = 1_000_000
    assert task_count(0, 4 * million, 200) == 200
    assert task_count(1e12, 4 * million, 200) == 250_000
    assert task_count(4e9, 4 * million, 200) == 1000
    assert block_size(0, 200, 4 * million) == SMALLEST_BLOCK
    assert block_size(160e6, 200, 4 * million) == 100_000
    assert block_size(1e15, 50_000, 4 * million) == 4 * million
    assert block_size(1e15, 50_000, 10) == 10
    assert block_size(160e6, 200, 4 * million, smallest=1_000_000) == 1_000_000


def test_a_single_hot_key_occupies_all_tasks(spark):
    air = silver_air(spark, [("hot", 7, float(i), 1, 1.0, 2.0, 1) for i in range(2500)])
    traffic = silver_traffic(spark, [("hot", 7, float(i)) for i in range(1000)])
    per_task = silver_join(air, traffic).groupBy(F.spark_partition_id()).count()
    sizes = [row["count"] for row in per_task.collect()]
    assert sum(sizes) == 2500 * 1000 and len(sizes) >= 3
    assert max(sizes) < 2500 * 1000 / 2


def test_join_is_partitioned_by_block(sides):
    """Neither side is broadcast, and the join adds no exchange of its own."""
    plan = silver_join(*sides)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2
    join = plan[plan.index("SortMergeJoin [zone") :]
    below = [line for line in join.splitlines() if "Exchange" in line]
    assert "REPARTITION_BY_NUM" in below[0] and "CartesianProduct" not in plan


@pytest.mark.parametrize("pairs_per_block", [1, 40, 10**6])
def test_any_block_size_gives_the_same_rows(sides, pairs_per_block):
    air, traffic = (side.unionByName(side) for side in sides)
    columns = plain_join(air, traffic).columns
    assert bag(silver_join(air, traffic, pairs_per_block), columns) == bag(
        plain_join(air, traffic), columns
    )


def test_empty_sides(spark):
    air, traffic = silver_air(spark, []), silver_traffic(spark, [])
    assert silver_join(air, traffic).count() == 0
    assert gold.pollution_mart(cells_of(air, traffic)).count() == 0


def test_join_without_matches_is_empty(spark):
    air = silver_air(spark, [("x", 1, 1.0, 1, 1.0, 1.0, 1)])
    assert silver_join(air, silver_traffic(spark, [("y", 1, 1.0)])).count() == 0


def test_marts_by_hand(sides):
    cells = cells_of(*sides)
    assert bag(gold.pollution_mart(cells), ["zone", "day", "avg_pollution", "max_pollution"]) == [
        ("a", 1, 26.0, 70.0),
        ("a", 2, 30.0, 30.0),
        ("b", 1, 1.0, 1.0),
    ]
    assert bag(gold.traffic_mart(cells), ["zone", "hour", "day", "avg_traffic", "max_traffic"]) == [
        ("a", 7, 1, 200.0, 300.0),
        ("a", 7, 2, 200.0, 300.0),
        ("a", 9, 1, 1000.0, 1000.0),
        ("b", 7, 1, 499.99, 500.0),
    ]
    levels = bag(gold.traffic_pollution_mart(cells), ["zone", "hour", "day", "traffic_level"])
    assert levels == [
        ("a", 7, 1, "Low Traffic"),
        ("a", 7, 2, "Low Traffic"),
        ("a", 9, 1, "High Traffic"),
        ("b", 7, 1, "Low Traffic"),
    ]
    hours = {r.hour: r.avg_hourly_traffic for r in gold.hourly_traffic(cells).collect()}
    assert hours == {7: pytest.approx((6 * 200.0 + 1499.98) / 9), 9: 1000.0}


def test_marts_are_ordered(sides):
    cells = cells_of(*sides)
    ordered = gold.in_order("datamart_traffic", gold.traffic_mart(cells))
    averages = [r.avg_traffic for r in ordered.collect()]
    assert averages == sorted(averages, reverse=True)
    ordered = gold.in_order("datamart_pollution", gold.pollution_mart(cells))
    averages = [r.avg_pollution for r in ordered.collect()]
    assert averages == sorted(averages, reverse=True)


def same_marts(air, traffic):
    joined = plain_join(air, traffic)
    pairs = [
        (gold.pollution_mart, gold.pollution_mart_from_silver),
        (gold.traffic_mart, gold.traffic_mart_from_silver),
        (gold.traffic_pollution_mart, gold.traffic_pollution_mart_from_silver),
    ]
    stored = merge_traffic_cells(traffic_cells(traffic, by_date=True))
    sources = [
        cells_of(air, traffic),
        pair_cells(air_cells(air), stored),
        cells_of_silver(joined),
    ]
    for from_cells, from_silver in pairs:
        expected = bag(from_silver(joined))
        for cells in sources:
            assert bag(from_cells(cells)) == expected
    expected = {r[0]: r[1] for r in gold.hourly_traffic_from_silver(joined).collect()}
    for cells in sources:
        hours = {r[0]: r[1] for r in gold.hourly_traffic(cells).collect()}
        assert hours == pytest.approx(expected, rel=1e-9)
    window = rolling_over_rows(joined).select("zone", "hour", "rolling_avg_pollution").distinct()
    expected = {}
    for row in window.collect():
        expected.setdefault((row.zone, row.hour), row.rolling_avg_pollution)
    by_hour = pair_cells(air_cells(air, by_date=False), traffic_cells(traffic))
    means = {(r.zone, r.hour): r[2] for r in rolling_by_hour(by_hour).collect()}
    assert means == pytest.approx(expected, rel=1e-9)
    digest = {(r.zone, r.hour): int(r.pairs) for r in gold.silver_digest(sources[0]).collect()}
    counted = joined.groupBy("zone", "hour").count().collect()
    assert digest == {(r.zone, r.hour): r["count"] for r in counted}


def test_cells_give_the_marts_of_the_joined_rows(sides):
    same_marts(*sides)


def cents(top):
    return st.integers(0, top).map(lambda n: n / 100)


AIR_ROW = st.tuples(
    st.sampled_from(["a", "b", "c"]),
    st.sampled_from([0, 7, 8, 23]),
    st.one_of(cents(10_000), st.none()),
    st.one_of(st.integers(0, 99), st.none()),
    cents(6_000),
    cents(10_000),
    st.integers(1, 2),
)
TRAFFIC_ROW = st.tuples(
    st.sampled_from(["a", "b", "d"]),
    st.sampled_from([0, 7, 8, 23]),
    st.one_of(cents(200_000), st.none()),
)


@settings(
    max_examples=6, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck)
)
@given(
    st.lists(AIR_ROW, min_size=1, max_size=30), st.lists(TRAFFIC_ROW, min_size=1, max_size=20)
)
def test_cells_give_the_marts_of_any_rows(spark, air, traffic):
    """Also with NULL metrics, as when a caller turns rules off."""
    same_marts(silver_air(spark, air), silver_traffic(spark, traffic))


def test_results_do_not_depend_on_broadcasts(spark):
    """Beyond the broadcast threshold, and without adaptive help, joins go by shuffle."""
    air = [("hot", 7, float(i % 50), i % 9, 1.0, 2.0, 1 + i % 3) for i in range(200)] + AIR
    traffic = [("hot", 7, float(i)) for i in range(100)] + TRAFFIC
    air, traffic = silver_air(spark, air), silver_traffic(spark, traffic)

    def results():
        cells = cells_of(air, traffic)
        joined = silver_join(air, traffic, pairs_per_block=500)
        joined = joined.withColumn("rolling_avg_pollution", F.round("rolling_avg_pollution", 9))
        return [
            bag(gold.pollution_mart(cells)),
            bag(gold.traffic_pollution_mart(cells)),
            bag(joined),
        ]

    expected = results()
    limits = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {key: spark.conf.get(key) for key in limits}
    try:
        for key, value in limits.items():
            spark.conf.set(key, value)
        assert "BroadcastHashJoin" not in plan_text(silver_join(air, traffic, 500))
        assert results() == expected
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- the view's grid, and sums in any order -------------------------------------------------------
def _hot_sides(spark):
    air = [("hot", 7, float(i), i % 90, 1.5 * (i % 7), 40.0, 1 + i % 3) for i in range(60)]
    air += [("cold", h, 1.0 * h, 1, 2.0, 3.0, 1) for h in range(5)] + [(None, 7, 1.0, 1, 2.0, 3.0, 1)]
    traffic = [("hot", 7, float(i)) for i in range(50)] + [("cold", 2, 5.0), ("hot", None, 1.0)]
    return silver_air(spark, air), silver_traffic(spark, traffic)


def test_view_joins_a_hot_key_in_many_tasks(spark):
    air, traffic = _hot_sides(spark)
    air.createOrReplaceTempView("grid_air")
    traffic.createOrReplaceTempView("grid_traffic")
    columns = ["zone", "hour", "pollution_value", "day", "debit_horaire"]
    expected = bag(plain_join(air, traffic), columns)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        tasks = {}
        for pairs in (10**6, 50, 1):
            rows = spark.sql(silver_view_sql("grid_air", "grid_traffic", pairs))
            assert bag(rows, columns) == expected
            tasks[pairs] = rows.filter("zone = 'hot'").select(F.spark_partition_id()).distinct().count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert tasks[10**6] == 1 and tasks[50] > 4 and tasks[1] > 4


def test_view_sends_copies_in_proportion_to_rows(spark):
    """A key of many pairs has a bounded number of blocks, so its rows are not repeated ever more often."""
    air = silver_air(spark, [("hot", 7, float(i), 1, 1.0, 2.0, 1) for i in range(400)])
    traffic = silver_traffic(spark, [("hot", 7, float(i)) for i in range(400)])
    air.createOrReplaceTempView("many_air")
    traffic.createOrReplaceTempView("many_traffic")
    sql = silver_view_sql("many_air", "many_traffic", 1).split("SELECT a.zone, a.hour")
    grids = "SELECT a.zone, a.hour".join(sql[:-1]) + "SELECT (SELECT count(*) FROM air_grid), (SELECT count(*) FROM traffic_grid)"
    copies = spark.sql(grids).first()
    assert max(copies) <= 400 * 10
    assert spark.sql(silver_view_sql("many_air", "many_traffic", 1)).count() == 400 * 400


@pytest.mark.parametrize("seed", [1, 2])
def test_marts_are_equal_bit_by_bit_in_any_order(spark, seed):
    draw = random.Random(seed)
    wild = [0.1, 1e13 + 0.3, -1e13, 1e-9, 3.3333333, 1e14, -1e14]
    value = lambda: draw.choice(wild) if draw.random() < 0.2 else draw.uniform(-50, 1000)
    air_rows = [("z", i % 3, value(), i % 90, value(), value(), 1 + i % 2) for i in range(400)]
    traffic_rows = [("z", i % 3, value()) for i in range(300)]
    found = []
    for parts in (1, 3, 8):
        draw.shuffle(air_rows)
        draw.shuffle(traffic_rows)
        air = silver_air(spark, air_rows).repartition(parts)
        traffic = silver_traffic(spark, traffic_rows).repartition(parts)
        cells = cells_of(air, traffic)
        rolled = rolling_by_hour(pair_cells(air_cells(air, by_date=False), traffic_cells(traffic)))
        tables = [cells, rolled, gold.hourly_traffic(cells), gold.pollution_mart(cells), gold.traffic_pollution_mart(cells)]
        found.append([sorted(map(repr, table.collect())) for table in tables])
    assert found[0] == found[1] == found[2]


def test_exact_sum(spark):
    for values in ([0.1] * 10, [1e17, 1.0, -1e17, 0.5], [None, -0.3, 0.1], [2.0**59, 2.0**-60], [-7.25, 0.0]):
        rows = spark.createDataFrame([(v,) for v in values], "v double")
        total = rows.agg(exact_sum(F.col("v")).alias("s")).first().s
        assert total == pytest.approx(math.fsum(v for v in values if v is not None), rel=1e-15)
    for values, expected in (([None], None), ([1e300, 1.0], 1e300), ([float("inf"), 1.0], float("inf"))):
        assert spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum(F.col("v"))).first()[0] == expected

"""Staging, validation and conforming on boundary values."""

from __future__ import annotations

import time
from datetime import date, datetime

import pytest
from fixtures import AIR_VALID, TRAFFIC_VALID, bag, raw_air, raw_traffic
from pyspark.sql import functions as F

from zonalake import fixed_values, standin
from zonalake.functions import (
    air_zone,
    hour_label,
    hour_of_text,
    level_label,
    rounded,
    traffic_level,
    traffic_zone,
    zone_label,
)
from zonalake.operators import conform, quality, staging
from zonalake.plans.metrics import layer_counts


def values(spark, texts, expression, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_air_hour_is_strict(spark):
    texts = ["01/02/2024 07:05", "1/2/2024 7:05", "31/02/2024 07:05", "2024-02-01 07:05", "", None]
    got = values(spark, texts, lambda c: hour_of_text(c, fixed_values.AIR_TIME_FORMAT))
    assert got == [7, None, None, None, None, None]


def test_traffic_hour_honours_offset_and_session_zone(spark):
    texts = ["2025-04-01T08:00:00+02:00", "2025-04-01T23:00:00", "bad", None]
    assert values(spark, texts, hour_of_text) == [6, 23, None, None]
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        assert values(spark, texts, hour_of_text) == [8, 23, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_zone_forms(spark):
    assert values(spark, ["Gare-du-Nord", "Saint Michel", "A_b", None], air_zone) == [
        "gare_du_nord",
        "saint_michel",
        "a_b",
        None,
    ]
    texts = ["Bd_Magenta", "Rue de Rivoli", "bd_x", "St-Michel", "Av_Bd_Bd_X", None]
    assert values(spark, texts, traffic_zone) == [
        "magenta",
        "rue_de_rivoli",
        "bd_x",
        "st-michel",
        "av_x",
        None,
    ]


def test_labels(spark):
    assert values(spark, ["gare_du_nord", "nation"], zone_label) == ["Gare Du Nord", "Nation"]
    assert values(spark, [7, 23], hour_label, "int") == ["07h", "23h"]
    assert values(spark, ["Low Traffic"], level_label) == ["Low"]


def test_traffic_level_bounds(spark):
    got = values(spark, [499.99, 500.0, 999.99, 1000.0, None], traffic_level, "double")
    assert got == ["Low Traffic", "Medium Traffic", "Medium Traffic", "High Traffic", "High Traffic"]


def test_rounding_settles_ties_upwards(spark):
    got = values(spark, [1.005, 2.675, 0.125, -0.125, None], rounded, "double")
    assert got == [1.01, 2.68, 0.13, -0.13, None]


def test_mapping_table():
    zones = list(fixed_values.ZONE_MAPPING.values())
    assert {zone: zones.count(zone) for zone in zones} == {
        "saint_michel": 6,
        "nation": 10,
        "gare_du_nord": 11,
        "paris_centre": 17,
    }


def test_map_zones(spark):
    df = spark.createDataFrame([("magenta",), ("av_ph_auguste",), ("x",), (None,)], "zone string")
    expected = [("gare_du_nord",), ("nation",), ("x",), (None,)]
    assert bag(conform.map_zones(df)) == sorted(expected, key=repr)
    assert bag(conform.map_zones(df, {})) == bag(df)


def test_map_zones_from_table(spark):
    df = spark.createDataFrame([("a",), ("b",)], "zone string")
    table = spark.createDataFrame([("A", "o"), ("a", "o")], "zone string, mapped string")
    assert bag(conform.map_zones(df, table)) == [("b",), ("o",)]
    table = spark.createDataFrame([("A", "p"), ("a", "o")], "zone string, mapped string")
    with pytest.raises(Exception, match="two zones"):
        conform.map_zones(df, table).collect()


def test_map_zones_rejects_conflict(spark):
    df = spark.createDataFrame([("a",)], "zone string")
    with pytest.raises(ValueError):
        conform.map_zones(df, {"A": "p", "a": "q"})


def test_only_the_mapping_is_broadcast(spark):
    df = spark.createDataFrame([("a",)], "zone string")
    plan = conform.map_zones(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftOuter, BuildRight" in plan


def test_validation_keeps_bounds_and_drops_null(spark):
    air = quality.valid_air(raw_air(spark))
    assert air.count() == AIR_VALID
    assert bag(air.filter("station = 'Nation'"), ["pollution_value"]) == [(60.0,)]
    traffic = quality.valid_traffic(raw_traffic(spark))
    assert traffic.count() == TRAFFIC_VALID
    assert bag(traffic.filter("debit_horaire NOT IN ('5', '300')"), ["debit_horaire"]) == [
        ("0",),
        ("1000",),
        ("12.5",),
        ("999",),
    ]


def test_quality_report(spark):
    report = quality.quality_report(raw_air(spark), raw_traffic(spark))
    failed = {(r.source, r.rule): r.failed for r in report.collect()}
    assert failed == {
        ("air", "pollution_present"): 1,
        ("air", "aqi_not_negative"): 2,
        ("air", "temperature_in_range"): 3,
        ("air", "humidity_in_range"): 3,
        ("air", "latitude_in_range"): 3,
        ("air", "time_readable"): 2,
        ("air", "any_rule"): 14,
        ("air", "pollution_finite"): 0,
        ("traffic", "count_finite"): 1,
        ("traffic", "count_present"): 1,
        ("traffic", "count_not_negative"): 3,
        ("traffic", "segment_open"): 3,
        ("traffic", "time_readable"): 2,
        ("traffic", "any_rule"): 9,
    }
    assert {r.rows for r in report.filter("source = 'air'").collect()} == {19}


def test_infinite_and_nan_values_have_their_own_rule(spark):
    odd = spark.sql(
        "SELECT * FROM VALUES (double('NaN')), (double('Infinity')), (double('-Infinity')), (1d) AS t(pollution_value)"
    )
    others = ("air_quality_index", "temperature", "humidity", "latitude")
    air = odd.withColumns({name: F.lit(1) for name in others})
    assert bag(quality.valid_air(air).select("pollution_value")) == [(1.0,)]
    counts = spark.createDataFrame([("NaN",), ("Infinity",), ("-Infinity",), ("x",), ("3",)], "debit_horaire string")
    counts = counts.withColumn("etat_arc", F.lit("Ouvert")).withColumn(
        "date_et_heure_de_comptage", F.lit("2025-04-01T07:00:00")
    )
    assert bag(quality.valid_traffic(counts).select("debit_horaire")) == [("3",)]
    air = air.withColumn("datetime", F.lit("01/02/2024 07:05"))
    failed = {(r.source, r.rule): r.failed for r in quality.quality_report(air, counts).collect()}
    assert failed["air", "pollution_finite"] == 3 and failed["traffic", "count_finite"] == 2
    kept = {n: r for n, r in fixed_values.TRAFFIC_RULES.items() if n != "count_finite"}
    assert quality.valid_traffic(counts, kept).count() == 3


def test_a_large_mapping_is_planned_quickly_and_by_its_size(spark):
    mapping = {f"label{i}": f"z{i}" for i in range(100_000)}
    begin = time.monotonic()
    df = conform.map_zones(spark.createDataFrame([("label7",), ("x",)], "zone string"), mapping)
    assert time.monotonic() - begin < 2
    assert bag(df) == [("x",), ("z7",)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1m")
    try:
        df = conform.map_zones(spark.createDataFrame([("x",)], "zone string"), mapping)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_labels_are_not_cut(spark, tmp_path):
    label = "9-" + "x" * 300
    spark.createDataFrame(
        [(1, "O", 1.0, datetime(2024, 1, 1), label)],
        "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    assert standin.traffic_csv(spark, str(tmp_path)).first().libelle == "Bd_" + "x" * 300


def test_rules_are_arguments(spark):
    assert quality.valid_air(raw_air(spark), {}).count() == 19
    assert quality.valid_air(raw_air(spark), {"warm": "temperature >= 60"}).count() == 2


def test_conformed_columns(spark):
    air = conform.conform_air(raw_air(spark))
    assert bag(air.filter("hour = 7 AND zone IS NOT NULL"), ["zone", "pollution_value"]) == [
        ("gare_du_nord", 10.0),
        ("gare_du_nord", 20.0),
    ]
    traffic = conform.conform_traffic(raw_traffic(spark))
    assert traffic.schema["debit_horaire"].dataType.simpleString() == "double"
    assert bag(traffic.filter("zone = 'gare_du_nord'"), ["hour", "debit_horaire"]) == [
        (7, 1000.0),
        (7, 12.5),
        (7, 999.0),
        (9, 0.0),
        (None, 5.0),
        (None, 5.0),
    ]


def test_stamp_and_dedup(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    stamped = staging.stamp_ingest_date(df, date(2025, 4, 1))
    assert bag(stamped, ["year", "month", "day"]) == [(2025, 4, 1)] * 4
    assert bag(staging.drop_duplicate_rows(df)) == [("a", 1), ("b", 2), ("b", 3)]
    assert staging.drop_duplicate_rows(df, ["k"]).count() == 2
    assert staging.drop_duplicate_rows(spark.range(0)).count() == 0
    again = staging.stamp_ingest_date(df, date(2025, 3, 31)).unionByName(stamped)
    kept = staging.drop_reingested(again)
    assert kept.columns == again.columns
    assert bag(kept, ["k", "v", "month", "day"]) == [("a", 1, 3, 31), ("b", 2, 3, 31), ("b", 3, 3, 31)]


def test_layer_counts(spark):
    counts = layer_counts(raw_air(spark), raw_traffic(spark))
    assert {r.layer: int(r.row_count) for r in counts.collect()} == {
        "raw_air": 19,
        "raw_traffic": 18,
        "valid_air": AIR_VALID,
        "valid_traffic": TRAFFIC_VALID,
        "silver": 2 * 3 + 1,
    }

"""One query per operator, over the raw tables derived from the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonalake import standin
from zonalake.fixed_values import HIGH, MEDIUM
from zonalake.functions import rounded, traffic_level
from zonalake.operators import cells as cell_ops
from zonalake.operators import conform, pairing, quality, rolling, staging
from zonalake.plans import dashboard, gold, layers, metrics, pages, reingest, summaries
from zonalake.schemas import AIR_TIME, DATE_KEYS, RAW_AIR, RAW_TRAFFIC, SILVER, TRAFFIC_CSV
from zonalake.session import settle, work_path
from zonalake.sinks import silver_view_sql, write_lake
from zonalake.sources import read_lake, read_traffic_csv

Query = Callable[[SparkSession, str], DataFrame]

# Selections used by the filtered queries.
ZONES = standin.ZONES
SOME_ZONES = ["click", "error", "view"]
HOURS = (6, 20)
LEVELS = [MEDIUM, HIGH]
# Pairs of a block of the view, few enough for keys of these tables to be split.
VIEW_PAIRS = 2_000


def _air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform_air(standin.raw_air(spark, sf_dir))


def _traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.conform_traffic(standin.raw_traffic(spark, sf_dir), standin.MAPPING)


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cell_ops.cells_of(_air(spark, sf_dir), _traffic(spark, sf_dir))


def _pollution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.pollution_mart(_cells(spark, sf_dir))


def _traffic_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.traffic_mart(_cells(spark, sf_dir))


def _traffic_pollution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.traffic_pollution_mart(_cells(spark, sf_dir))


def _over(mart: Query, plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(mart(spark, sf_dir))


def _ordered(name: str, mart: Query) -> Query:
    return _over(mart, lambda rows: gold.in_order(name, rows))


def _select_pollution(mart: DataFrame) -> DataFrame:
    return dashboard.filter_pollution(mart, SOME_ZONES)


def _select_traffic(mart: DataFrame) -> DataFrame:
    return dashboard.filter_traffic(mart, SOME_ZONES, HOURS)


def _select_traffic_pollution(mart: DataFrame) -> DataFrame:
    return dashboard.filter_traffic_pollution(mart, SOME_ZONES, HOURS, LEVELS)


# --- raw layer


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "traffic-csv")
    standin.traffic_csv(spark, sf_dir).write.option("header", True).csv(path)
    return read_traffic_csv(spark, path, TRAFFIC_CSV)


def scan_raw_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "raw-air")
    write_lake(standin.raw_air(spark, sf_dir), path, rebalance=True)
    return read_lake(spark, path, RAW_AIR)


def scan_raw_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "raw-traffic")
    write_lake(standin.raw_traffic(spark, sf_dir), path)
    return read_lake(spark, path, RAW_TRAFFIC)


def stamp_ingest_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stamp_ingest_date(
        standin.traffic_csv(spark, sf_dir), standin.TRAFFIC_INGEST_DATE
    )


def dedup_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch ingested on two dates, with what came again removed."""
    batch = standin.raw_air(spark, sf_dir).drop("year", "month", "day")
    days = [staging.stamp_ingest_date(batch, day) for day in standin.AIR_INGEST_DATES]
    return staging.drop_reingested(days[1].unionByName(days[0]))


def dedup_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches ingested on several dates, one of them late and one again without a batch, with
    rows that came again removed a date at a time against the index of row hashes."""
    raw, index, kept = (work_path(spark, name) for name in ("dated-air", "air-index", "first-air"))
    rows = standin.raw_air(spark, sf_dir).drop("year", "month", "day")
    batch = F.col("air_quality_index") % 3
    for day, batches in standin.AIR_BATCHES:
        layers.ingest(rows.filter(batch.isin(batches)), raw, day)
        reingest.refresh_first_rows(spark, raw, index, kept, RAW_AIR, AIR_TIME, day)
    return read_lake(spark, kept, RAW_AIR)


# --- staging


def air_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = conform.with_air_hour(standin.raw_air(spark, sf_dir))
    return staged.select("station", "datetime", "hour")


def traffic_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = conform.with_traffic_hour(standin.raw_traffic(spark, sf_dir))
    return staged.select("libelle", "date_et_heure_de_comptage", "hour")


def air_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = conform.with_air_zone(standin.raw_air(spark, sf_dir))
    return staged.select("station", "datetime", "zone")


def traffic_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = conform.with_traffic_zone(standin.raw_traffic(spark, sf_dir))
    return staged.select("libelle", "date_et_heure_de_comptage", "zone")


def zone_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = conform.with_traffic_zone(standin.raw_traffic(spark, sf_dir))
    mapped = conform.map_zones(staged, standin.MAPPING)
    return mapped.select("libelle", "date_et_heure_de_comptage", "zone")


def validate_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.valid_air(standin.raw_air(spark, sf_dir))


def validate_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.valid_traffic(standin.raw_traffic(spark, sf_dir))


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(
        standin.raw_air(spark, sf_dir), standin.raw_traffic(spark, sf_dir)
    )


def rejected_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that validation rejects, read back from the quarantine that one write filled."""
    path = work_path(spark, "quarantine")
    air = layers.checked_sides(
        standin.raw_air(spark, sf_dir), standin.raw_traffic(spark, sf_dir), standin.MAPPING
    )["air"]
    write_lake(air, layers.checked_path(path, "air"), keys=[*DATE_KEYS, quality.REJECTED], rebalance=True)
    return layers.rejected_rows(spark, path, "air")


# --- silver


def silver_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = pairing.silver_join(_air(spark, sf_dir), _traffic(spark, sf_dir))
    return joined.drop("rolling_avg_pollution")


def silver_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view over both stored sides, each key joined as a grid of blocks."""
    sides = {"air": _air(spark, sf_dir), "traffic": _traffic(spark, sf_dir)}
    for side, rows in sides.items():
        write_lake(rows, path := work_path(spark, f"view-{side}"), whole=True)
        read_lake(spark, path, rows.schema).createOrReplaceTempView(f"zonalake_view_{side}")
    sql = silver_view_sql("zonalake_view_air", "zonalake_view_traffic", VIEW_PAIRS)
    return spark.sql(sql).drop("rolling_avg_pollution")


def rolling_avg_pollution(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_hour = cell_ops.air_cells(_air(spark, sf_dir), by_date=False)
    cells = cell_ops.pair_cells(by_hour, cell_ops.traffic_cells(_traffic(spark, sf_dir)))
    means = rolling.rolling_by_hour(cells)
    return means.withColumn("rolling_avg_pollution", rounded(F.col("rolling_avg_pollution"), 4))


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "silver")
    silver = pairing.silver_join(_air(spark, sf_dir), _traffic(spark, sf_dir))
    write_lake(silver, path, rebalance=True)
    stored = read_lake(spark, path, SILVER)
    return stored.withColumn("rolling_avg_pollution", rounded(F.col("rolling_avg_pollution"), 4))


def hourly_traffic(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = gold.hourly_traffic(_cells(spark, sf_dir))
    return hours.withColumn("avg_hourly_traffic", rounded(F.col("avg_hourly_traffic"), 4))


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.layer_counts(
        standin.raw_air(spark, sf_dir), standin.raw_traffic(spark, sf_dir), standin.MAPPING
    )


# --- pages


def traffic_page_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second page by the cursor of the first."""
    mart = settle(_traffic_mart(spark, sf_dir), "traffic")
    first = pages.cursor_reply(pages.traffic_page(mart, zone="click"), pages.TRAFFIC_ORDER, 20)
    if first["next"] is None:
        return mart.limit(0)
    return pages.traffic_page(mart, zone="click", after=first["next"])


# --- gold


def level_of_marts(mart: DataFrame) -> DataFrame:
    """The level function on the traffic mart's own averages."""
    return mart.select(
        "zone",
        "hour",
        "year",
        "month",
        "day",
        "avg_traffic",
        traffic_level(F.col("avg_traffic")).alias("traffic_level"),
    )


def corr_rounded(mart: DataFrame) -> DataFrame:
    return summaries.traffic_pollution_corr(mart).withColumn(
        "correlation", rounded(F.col("correlation"), 4)
    )


def kpi_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both marts come from one settled pre-aggregate, so the raw tables are read once."""
    cells = settle(_cells(spark, sf_dir), "cells")
    return dashboard.kpi_board(
        _select_pollution(gold.pollution_mart(cells)), _select_traffic(gold.traffic_mart(cells))
    )


def pollution_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share needs the mart twice, so the mart is settled, as it is when the job stores it."""
    mart = settle(_pollution(spark, sf_dir), "pollution")
    return dashboard.pollution_share(_select_pollution(mart))


def queries() -> dict[str, Query]:
    select_pollution = _over(_pollution, _select_pollution)
    select_traffic = _over(_traffic_mart, _select_traffic)
    select_both = _over(_traffic_pollution, _select_traffic_pollution)
    return {
        "csv_roundtrip": csv_roundtrip,
        "scan_raw_air": scan_raw_air,
        "scan_raw_traffic": scan_raw_traffic,
        "stamp_ingest_date": stamp_ingest_date,
        "dedup_air": dedup_air,
        "dedup_by_index": dedup_by_index,
        "air_hour": air_hour,
        "traffic_hour": traffic_hour,
        "air_zone": air_zone,
        "traffic_zone": traffic_zone,
        "zone_mapping": zone_mapping,
        "validate_air": validate_air,
        "validate_traffic": validate_traffic,
        "quality_report": quality_report,
        "rejected_air": rejected_air,
        "silver_join": silver_join,
        "silver_view": silver_view,
        "silver_digest": _over(_cells, gold.silver_digest),
        "rolling_avg_pollution": rolling_avg_pollution,
        "silver_roundtrip": silver_roundtrip,
        "hourly_traffic": hourly_traffic,
        "layer_counts": layer_counts,
        "datamart_pollution": _ordered("datamart_pollution", _pollution),
        "datamart_traffic": _ordered("datamart_traffic", _traffic_mart),
        "datamart_traffic_pollution": _traffic_pollution,
        "traffic_level": _over(_traffic_mart, level_of_marts),
        "pollution_page": _over(
            _pollution, lambda mart: pages.pollution_page(mart, page=2, limit=10, zone="click")
        ),
        "traffic_page": _over(
            _traffic_mart, lambda mart: pages.traffic_page(mart, page=2, zone="click")
        ),
        "traffic_page_after": traffic_page_after,
        "traffic_pollution_page": _over(
            _traffic_pollution,
            lambda mart: pages.traffic_pollution_page(
                mart, page=3, limit=50, traffic_level=HIGH
            ),
        ),
        "pollution_summary": _over(_pollution, summaries.pollution_summary),
        "traffic_by_hour": _over(_traffic_mart, summaries.traffic_by_hour),
        "traffic_by_zone": _over(_traffic_mart, summaries.traffic_by_zone),
        "traffic_heatmap": _over(_traffic_mart, summaries.traffic_heatmap),
        "traffic_pollution_summary": _over(
            _traffic_pollution, summaries.traffic_pollution_summary
        ),
        "traffic_pollution_by_level": _over(
            _traffic_pollution, summaries.traffic_pollution_by_level
        ),
        "dash_filter_pollution": select_pollution,
        "dash_filter_traffic": select_traffic,
        "dash_filter_tp": select_both,
        "dash_pollution_by_zone": _over(select_pollution, dashboard.pollution_by_zone),
        "dash_traffic_by_zone": _over(select_traffic, dashboard.traffic_by_zone),
        "dash_traffic_by_hour_zone": _over(select_traffic, dashboard.traffic_by_hour_zone),
        "dash_heatmap_pivot": _over(
            _traffic_mart, lambda mart: dashboard.heatmap_pivot(mart, ZONES)
        ),
        "dash_tp_by_zone": _over(select_both, dashboard.traffic_pollution_by_zone),
        "dash_by_level": _over(select_both, dashboard.pollution_by_level),
        "dash_level_bars": _over(select_both, dashboard.level_bars),
        "kpi_board": kpi_board,
        "pollution_share": pollution_share,
        "env_conditions": _over(select_both, dashboard.env_conditions),
        "tp_bubble": _over(select_both, dashboard.traffic_pollution_bubbles),
        "traffic_pollution_corr": _over(_traffic_pollution, corr_rounded),
    }

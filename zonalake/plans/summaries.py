"""Summaries of the gold marts, rounded to two decimals.

Averages are means of the marts' already rounded averages, each mart row counting once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalake.functions import rounded


def mean_of(name: str, places: int = 2) -> Column:
    return rounded(F.avg(name), places).alias(name)


def max_of(name: str, places: int = 2) -> Column:
    return rounded(F.max(name), places).alias(name)


def pollution_summary(mart: DataFrame) -> DataFrame:
    """By zone, most polluted first."""
    return (
        mart.groupBy("zone")
        .agg(mean_of("avg_pollution"), max_of("max_pollution"), mean_of("avg_aqi"))
        .orderBy(F.desc("avg_pollution"), "zone")
    )


def traffic_by_hour(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("hour").agg(mean_of("avg_traffic"), max_of("max_traffic")).orderBy("hour")
    )


def traffic_by_zone(mart: DataFrame) -> DataFrame:
    """By zone, most congested first."""
    return (
        mart.groupBy("zone")
        .agg(mean_of("avg_traffic"), max_of("max_traffic"))
        .orderBy(F.desc("avg_traffic"), "zone")
    )


def traffic_heatmap(mart: DataFrame) -> DataFrame:
    """One row per zone and hour."""
    return mart.groupBy("zone", "hour").agg(mean_of("avg_traffic")).orderBy("zone", "hour")


def traffic_pollution_summary(mart: DataFrame) -> DataFrame:
    """By zone, most congested first."""
    return (
        mart.groupBy("zone")
        .agg(
            mean_of("avg_traffic"),
            mean_of("avg_pollution"),
            mean_of("avg_temperature"),
            mean_of("avg_humidity"),
        )
        .orderBy(F.desc("avg_traffic"), "zone")
    )


def traffic_pollution_by_level(mart: DataFrame) -> DataFrame:
    """By traffic level, most polluted first."""
    return (
        mart.groupBy("traffic_level")
        .agg(
            F.count(F.lit(1)).alias("count"),
            mean_of("avg_pollution"),
            mean_of("avg_temperature"),
            mean_of("avg_humidity"),
        )
        .orderBy(F.desc("avg_pollution"), "traffic_level")
    )


def traffic_pollution_corr(mart: DataFrame) -> DataFrame:
    """Correlation of traffic and pollution over mart rows, by zone and for all zones together
    (zone NULL). NULL where a side does not vary."""
    return mart.rollup("zone").agg(
        F.count(F.lit(1)).alias("count"),
        F.corr("avg_traffic", "avg_pollution").alias("correlation"),
    )

"""Dashboard selections, series and key figures over the gold marts, rounded to one decimal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalake.fixed_values import (
    BUBBLE_FACTOR,
    BUBBLE_FLOOR,
    EMPTY_AVERAGE,
    NO_VALUE,
    TRAFFIC_LEVELS,
    ZONE_ORDER,
)
from zonalake.functions import hour_label, level_label, rounded, zone_label
from zonalake.plans.summaries import max_of, mean_of

ALL_HOURS = (0, 23)


def filter_pollution(mart: DataFrame, zones: list[str] = ZONE_ORDER) -> DataFrame:
    """Rows of the selected zones."""
    return mart.filter(F.col("zone").isin(zones))


def filter_traffic(
    mart: DataFrame, zones: list[str] = ZONE_ORDER, hours: tuple[int, int] = ALL_HOURS
) -> DataFrame:
    """Rows of the selected zones and hours, both ends included."""
    return filter_pollution(mart, zones).filter(F.col("hour").between(*hours))


def filter_traffic_pollution(
    mart: DataFrame,
    zones: list[str] = ZONE_ORDER,
    hours: tuple[int, int] = ALL_HOURS,
    levels: list[str] = TRAFFIC_LEVELS,
) -> DataFrame:
    """Rows of the selected zones, hours and traffic levels."""
    return filter_traffic(mart, zones, hours).filter(F.col("traffic_level").isin(levels))


def _zone_pollution(selected: DataFrame) -> DataFrame:
    return selected.groupBy("zone").agg(
        mean_of("avg_pollution", 1), max_of("max_pollution", 1), mean_of("avg_aqi", 1)
    )


def _zone_traffic(selected: DataFrame) -> DataFrame:
    return selected.groupBy("zone").agg(mean_of("avg_traffic", 1), max_of("max_traffic", 1))


def _zone_conditions(selected: DataFrame) -> DataFrame:
    return selected.groupBy("zone").agg(
        mean_of("avg_traffic", 1),
        mean_of("avg_pollution", 1),
        mean_of("avg_temperature", 1),
        mean_of("avg_humidity", 1),
    )


def pollution_by_zone(selected: DataFrame) -> DataFrame:
    """Most polluted first."""
    return _zone_pollution(selected).orderBy(F.desc("avg_pollution"), "zone")


def traffic_by_zone(selected: DataFrame) -> DataFrame:
    """Most congested first."""
    return _zone_traffic(selected).orderBy(F.desc("avg_traffic"), "zone")


def traffic_by_hour_zone(selected: DataFrame) -> DataFrame:
    """One line of hours per zone; also the long form of the heatmap."""
    return selected.groupBy("hour", "zone").agg(mean_of("avg_traffic", 1)).orderBy("hour", "zone")


def heatmap_pivot(
    selected: DataFrame, zones: list[str] = ZONE_ORDER, hours: tuple[int, int] = ALL_HOURS
) -> DataFrame:
    """One row per zone, one column per hour, 0 where no row exists. Zones follow the given order;
    others are left out. The hours are known, so no job has to look them up."""
    names = [f"{hour:02d}h" for hour in range(hours[0], hours[1] + 1)]
    rank = F.array_position(F.array(*[F.lit(z) for z in zones]), F.col("zone"))
    return (
        filter_traffic(selected, zones, hours)
        .groupBy("zone")
        .pivot("hour", list(range(hours[0], hours[1] + 1)))
        .agg(rounded(F.avg("avg_traffic"), 1))
        .toDF("zone", *names)
        .na.fill(0.0, names)
        .orderBy(rank)
        .withColumn("zone", zone_label(F.col("zone")))
    )


def traffic_pollution_by_zone(selected: DataFrame) -> DataFrame:
    return _zone_conditions(selected).orderBy("zone")


def pollution_by_level(selected: DataFrame) -> DataFrame:
    """Mean pollution per level, and the number of rows that have one."""
    return (
        selected.groupBy("traffic_level")
        .agg(mean_of("avg_pollution", 1), F.count("avg_pollution").alias("count"))
        .orderBy("traffic_level")
    )


def level_bars(selected: DataFrame) -> DataFrame:
    """`pollution_by_level` with the short level name."""
    return pollution_by_level(selected).withColumn(
        "traffic_level", level_label(F.col("traffic_level"))
    )


def pollution_share(selected: DataFrame) -> DataFrame:
    """Each zone's mean pollution as a percentage of the sum over zones, largest first. The sum is
    a scalar subquery, so no window gathers all zones in one task."""
    by_zone = _zone_pollution(selected).select("zone", "avg_pollution")
    total = by_zone.agg(F.sum("avg_pollution")).scalar()
    share = rounded(F.try_divide(F.col("avg_pollution") * 100.0, total), 1)
    return by_zone.select(
        zone_label(F.col("zone")).alias("zone"), "avg_pollution", share.alias("share_percent")
    ).orderBy(F.desc("avg_pollution"), "zone")


def traffic_pollution_bubbles(selected: DataFrame) -> DataFrame:
    """The zone means with a label and a bubble size from humidity."""
    size = F.greatest(F.lit(BUBBLE_FLOOR), F.col("avg_humidity") * BUBBLE_FACTOR)
    return traffic_pollution_by_zone(selected).select(
        zone_label(F.col("zone")).alias("zone"),
        "avg_traffic",
        "avg_pollution",
        "avg_temperature",
        "avg_humidity",
        rounded(size, 2).alias("bubble_size"),
    )


def env_conditions(selected: DataFrame) -> DataFrame:
    """Temperature and humidity per zone, warmest first."""
    return (
        _zone_conditions(selected)
        .select(zone_label(F.col("zone")).alias("zone"), "avg_temperature", "avg_humidity")
        .orderBy(F.desc("avg_temperature"), "zone")
    )


def _descending(value: str, key: str) -> Column:
    return F.when(F.col(value).isNotNull(), F.struct(-F.col(value), F.col(key)))


def kpi_board(pollution: DataFrame, traffic: DataFrame) -> DataFrame:
    """The five key figures as one row, from the selected pollution and traffic rows.

    Ties: the alphabetically first zone is the most polluted or congested, the last one the
    cleanest, and the lowest hour is the peak. The three summaries are stacked and reduced by one
    global aggregate.
    """
    polluted = _zone_pollution(pollution).select(
        F.col("zone").alias("polluted_zone"), "avg_pollution"
    )
    congested = _zone_traffic(traffic).select(
        F.col("zone").alias("congested_zone"), "avg_traffic"
    )
    hours = traffic.groupBy("hour").agg(F.avg("avg_traffic").alias("hour_traffic"))
    stacked = polluted.unionByName(congested, allowMissingColumns=True).unionByName(
        hours, allowMissingColumns=True
    )
    pollution_rank = _descending("avg_pollution", "polluted_zone")
    return stacked.agg(
        zone_label(F.min_by("polluted_zone", pollution_rank)).alias("most_polluted"),
        zone_label(
            F.min_by("congested_zone", _descending("avg_traffic", "congested_zone"))
        ).alias("most_congested"),
        F.min_by("hour", _descending("hour_traffic", "hour")).alias("hour"),
        rounded(F.avg("avg_pollution"), 1).alias("avg_pollution"),
        zone_label(F.max_by("polluted_zone", pollution_rank)).alias("cleanest"),
    ).select(
        F.coalesce("most_polluted", F.lit(NO_VALUE)).alias("most_polluted"),
        F.coalesce("most_congested", F.lit(NO_VALUE)).alias("most_congested"),
        F.when(F.col("hour").isNotNull(), hour_label(F.col("hour")))
        .otherwise(NO_VALUE)
        .alias("peak_hour"),
        F.coalesce("avg_pollution", F.lit(EMPTY_AVERAGE)).alias("avg_pollution"),
        F.coalesce("cleanest", F.lit(NO_VALUE)).alias("cleanest"),
    )

"""Gold marts.

Each mart comes in two forms with equal results: from paired cells (see `operators.cells`), which is
what the jobs run, and from a joined silver table, for those who hold one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalake.functions import rounded, traffic_level, weighted_mean
from zonalake.schemas import DATE_KEYS, POLLUTION_MART, TRAFFIC_MART, TRAFFIC_POLLUTION_MART

ZONE_DATE = ["zone", *DATE_KEYS]
ZONE_HOUR_DATE = ["zone", "hour", *DATE_KEYS]


def _mean(name: str):
    return F.try_divide(F.col(f"sum_{name}"), F.col(f"n_{name}"))


def _mean_over_pairs(name: str, weight: str):
    return weighted_mean(F.col(f"sum_{name}"), F.col(f"n_{name}"), F.col(weight))


# By what a mart is listed, highest first, and what breaks ties; the third mart has no order.
MART_ORDER = {
    "datamart_pollution": ("avg_pollution", ZONE_DATE),
    "datamart_traffic": ("avg_traffic", ZONE_HOUR_DATE),
}


def in_order(name: str, mart: DataFrame) -> DataFrame:
    """The mart in its order. Marts are built without one, as what reads them would sort in vain."""
    if name not in MART_ORDER:
        return mart
    value, ties = MART_ORDER[name]
    return mart.orderBy(F.desc(value), *ties)


def pollution_mart(cells: DataFrame) -> DataFrame:
    """Pollution and air quality by zone and date. Hours weigh by their traffic rows, as they do
    over the joined rows."""
    mart = cells.groupBy(*ZONE_DATE).agg(
        rounded(_mean_over_pairs("pollution_value", "traffic_rows")).alias("avg_pollution"),
        rounded(F.max("max_pollution_value")).alias("max_pollution"),
        rounded(_mean_over_pairs("air_quality_index", "traffic_rows")).alias("avg_aqi"),
    )
    return mart.select(*POLLUTION_MART)


def traffic_mart(cells: DataFrame) -> DataFrame:
    """Traffic by zone, hour and date."""
    mart = cells.select(
        *ZONE_HOUR_DATE,
        rounded(_mean("debit_horaire")).alias("avg_traffic"),
        rounded(F.col("max_debit_horaire")).alias("max_traffic"),
    )
    return mart.select(*TRAFFIC_MART)


def traffic_pollution_mart(cells: DataFrame) -> DataFrame:
    """Traffic, pollution and weather by zone, hour and date, with the traffic level."""
    mart = cells.select(
        *ZONE_HOUR_DATE,
        rounded(_mean("pollution_value")).alias("avg_pollution"),
        rounded(_mean("debit_horaire")).alias("avg_traffic"),
        rounded(_mean("temperature")).alias("avg_temperature"),
        rounded(_mean("humidity")).alias("avg_humidity"),
    )
    return mart.withColumn("traffic_level", traffic_level(F.col("avg_traffic"))).select(
        *TRAFFIC_POLLUTION_MART
    )


def hourly_traffic(cells: DataFrame) -> DataFrame:
    """Mean traffic per hour over the joined rows, not rounded."""
    return cells.groupBy("hour").agg(
        _mean_over_pairs("debit_horaire", "air_rows").alias("avg_hourly_traffic")
    )


def silver_digest(cells: DataFrame) -> DataFrame:
    """What the joined table holds per zone and hour: number of pairs, and extremes of three
    columns."""
    per_hour = cells.groupBy("zone", "hour").agg(
        F.sum("air_rows").alias("air_rows"),
        F.max("traffic_rows").alias("traffic_rows"),
        F.max("max_pollution_value").alias("max_pollution"),
        F.min("min_debit_horaire").alias("min_traffic"),
        F.max("max_debit_horaire").alias("max_traffic"),
    )
    pairs = F.col("air_rows").cast("decimal(19,0)") * F.col("traffic_rows").cast("decimal(18,0)")
    return per_hour.select(
        "zone",
        "hour",
        pairs.cast("decimal(38,0)").alias("pairs"),
        "max_pollution",
        "min_traffic",
        "max_traffic",
    )


def pollution_mart_from_silver(silver: DataFrame) -> DataFrame:
    mart = silver.groupBy(*ZONE_DATE).agg(
        rounded(F.avg("pollution_value")).alias("avg_pollution"),
        rounded(F.max("pollution_value")).alias("max_pollution"),
        rounded(F.avg("air_quality_index")).alias("avg_aqi"),
    )
    return mart.select(*POLLUTION_MART)


def traffic_mart_from_silver(silver: DataFrame) -> DataFrame:
    mart = silver.groupBy(*ZONE_HOUR_DATE).agg(
        rounded(F.avg("debit_horaire")).alias("avg_traffic"),
        rounded(F.max("debit_horaire")).alias("max_traffic"),
    )
    return mart.select(*TRAFFIC_MART)


def traffic_pollution_mart_from_silver(silver: DataFrame) -> DataFrame:
    mart = silver.groupBy(*ZONE_HOUR_DATE).agg(
        rounded(F.avg("pollution_value")).alias("avg_pollution"),
        rounded(F.avg("debit_horaire")).alias("avg_traffic"),
        rounded(F.avg("temperature")).alias("avg_temperature"),
        rounded(F.avg("humidity")).alias("avg_humidity"),
    )
    return mart.withColumn("traffic_level", traffic_level(F.col("avg_traffic"))).select(
        *TRAFFIC_POLLUTION_MART
    )


def hourly_traffic_from_silver(silver: DataFrame) -> DataFrame:
    return silver.groupBy("hour").agg(F.avg("debit_horaire").alias("avg_hourly_traffic"))

"""Pre-aggregates of the two silver sides, one row per zone and hour ("cells").

The silver join pairs every air row with every traffic row of the same zone and hour. Inside such a
cell each air row is repeated once per traffic row and the other way round, so counts, sums, means
and maxima over the pairs follow from sums, counts and maxima of the sides. All of gold is built
from cells; the pairs are never formed for it.

Cells combine in the map tasks, so a hot zone or hour shuffles only one row per task. They are also
additive over ingest dates, so a stored cell table needs only the new date's rows. Sums do not depend
on the order of rows (`functions.exact_sum`), so equal rows give equal cells, bit by bit, in any run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalake.functions import exact_sum
from zonalake.schemas import AIR_METRICS, DATE_KEYS, ZONE_HOUR


def _parts(name: str) -> list[Column]:
    value = F.col(name)
    return [
        exact_sum(value).alias(f"sum_{name}"),
        F.count(value).alias(f"n_{name}"),
        F.max(value).alias(f"max_{name}"),
    ]


def air_cells(air: DataFrame, by_date: bool = True) -> DataFrame:
    """Per zone and hour (and date): rows, and sum, count and maximum of each metric."""
    keys = ZONE_HOUR + (DATE_KEYS if by_date else [])
    parts = [part for name in AIR_METRICS for part in _parts(name)]
    return air.groupBy(*keys).agg(F.count(F.lit(1)).alias("air_rows"), *parts)


def traffic_cells(traffic: DataFrame, by_date: bool = False) -> DataFrame:
    """Per zone and hour (and ingest date): rows, and sum, count, minimum and maximum of the count."""
    keys = ZONE_HOUR + (DATE_KEYS if by_date else [])
    return traffic.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("traffic_rows"),
        *_parts("debit_horaire"),
        F.min("debit_horaire").alias("min_debit_horaire"),
    )


def merge_traffic_cells(stored: DataFrame) -> DataFrame:
    """Cells stored by ingest date, combined to one row per zone and hour."""
    return stored.groupBy(*ZONE_HOUR).agg(
        F.sum("traffic_rows").alias("traffic_rows"),
        exact_sum(F.col("sum_debit_horaire")).alias("sum_debit_horaire"),
        F.sum("n_debit_horaire").alias("n_debit_horaire"),
        F.max("max_debit_horaire").alias("max_debit_horaire"),
        F.min("min_debit_horaire").alias("min_debit_horaire"),
    )


def pair_cells(air: DataFrame, traffic: DataFrame) -> DataFrame:
    """Air cells with the traffic cell of their zone and hour; both must exist, as in the join."""
    return air.join(traffic, ZONE_HOUR)


def cells_of(air: DataFrame, traffic: DataFrame) -> DataFrame:
    """Paired cells straight from the two silver sides."""
    return pair_cells(air_cells(air), traffic_cells(traffic))


def cells_of_silver(silver: DataFrame) -> DataFrame:
    """Paired cells from a joined silver table, in one pass over it.

    A joined row stands for one air row that met one traffic row, so the cell has as many air rows
    as pairs and one traffic row, with the traffic sums taken per pair.
    """
    pairs = F.count(F.lit(1))
    parts = [part for name in AIR_METRICS for part in _parts(name)]
    count = F.col("debit_horaire")
    return silver.groupBy(*ZONE_HOUR, *DATE_KEYS).agg(
        pairs.alias("air_rows"),
        *parts,
        F.lit(1).cast("bigint").alias("traffic_rows"),
        (exact_sum(count) / pairs).alias("sum_debit_horaire"),
        (F.count(count) / pairs).alias("n_debit_horaire"),
        F.max(count).alias("max_debit_horaire"),
        F.min(count).alias("min_debit_horaire"),
    )

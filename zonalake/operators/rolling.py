"""Cumulative mean pollution of a zone over the hours up to each hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonalake.schemas import ZONE_HOUR


def rolling_mean() -> Column:
    """The mean over paired cells, as a window over them.

    A window ordered by hour without a frame covers all rows up to and including the current hour,
    so the value is the same for all rows of a zone and hour, and cells weighted by the pairs they
    stand for give it. The window sees the cells of a zone instead of all its rows.
    """
    weight = F.col("traffic_rows").cast("double")
    upto = Window.partitionBy("zone").orderBy("hour")
    total = F.sum(F.col("sum_pollution_value") * weight).over(upto)
    rows = F.sum(F.col("n_pollution_value") * weight).over(upto)
    return F.try_divide(total, rows)


def rolling_by_hour(cells: DataFrame) -> DataFrame:
    """The mean per zone and hour, from paired cells by hour."""
    return cells.select(*ZONE_HOUR, rolling_mean().alias("rolling_avg_pollution"))


def rolling_over_rows(silver: DataFrame) -> DataFrame:
    """The same as a window over joined rows. It sorts a whole zone in one task, so it serves small
    tables and as the check of `rolling_by_hour`."""
    upto = Window.partitionBy("zone").orderBy("hour")
    return silver.withColumn("rolling_avg_pollution", F.avg("pollution_value").over(upto))

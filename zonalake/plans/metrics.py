"""Row counts of the layers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalake.fixed_values import AIR_RULES, TRAFFIC_RULES, ZONE_MAPPING
from zonalake.operators.conform import (
    map_zones,
    with_air_hour,
    with_air_zone,
    with_traffic_hour,
    with_traffic_zone,
)
from zonalake.schemas import ZONE_HOUR


def _all_true(rules: Mapping[str, str]):
    return F.expr(" AND ".join(f"coalesce({rule}, false)" for rule in rules.values()))


def layer_counts(
    raw_air: DataFrame,
    raw_traffic: DataFrame,
    mapping: Mapping[str, str] | DataFrame = ZONE_MAPPING,
    air_rules: Mapping[str, str] = AIR_RULES,
    traffic_rules: Mapping[str, str] = TRAFFIC_RULES,
) -> DataFrame:
    """Rows of each layer, in one scan per raw table. The joined rows are counted from the two
    sides' counts. Counts are DECIMAL because pairs may exceed a long."""
    air = (
        with_air_zone(with_air_hour(raw_air))
        .groupBy(*ZONE_HOUR)
        .agg(
            F.count(F.lit(1)).alias("raw_air"),
            F.count_if(_all_true(air_rules)).alias("valid_air"),
        )
    )
    traffic = (
        map_zones(with_traffic_zone(with_traffic_hour(raw_traffic)), mapping)
        .groupBy(*ZONE_HOUR)
        .agg(
            F.count(F.lit(1)).alias("raw_traffic"),
            F.count_if(_all_true(traffic_rules)).alias("valid_traffic"),
        )
    )
    pairs = F.col("valid_air").cast("decimal(19,0)") * F.col("valid_traffic").cast("decimal(18,0)")
    layers = ["raw_air", "raw_traffic", "valid_air", "valid_traffic", "silver"]
    totals = (
        air.join(traffic, ZONE_HOUR, "full")
        .withColumn("silver", pairs)
        .agg(
            *[F.coalesce(F.sum(n), F.lit(0)).cast("decimal(38,0)").alias(n) for n in layers]
        )
    )
    lines = [F.struct(F.lit(n).alias("layer"), F.col(n).alias("row_count")) for n in layers]
    return totals.select(F.inline(F.array(*lines)))

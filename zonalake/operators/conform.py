"""Conformed sides of the silver layer: hour, zone, zone mapping, useful columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalake.fixed_values import AIR_RULES, AIR_TIME_FORMAT, TRAFFIC_RULES, ZONE_MAPPING
from zonalake.functions import air_zone, hour_of_text, traffic_zone
from zonalake.operators.quality import valid_air, valid_traffic
from zonalake.schemas import AIR_METRICS, DATE_KEYS


def with_air_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("hour", hour_of_text(F.col("datetime"), AIR_TIME_FORMAT))


def with_traffic_hour(df: DataFrame) -> DataFrame:
    return df.withColumn("hour", hour_of_text(F.col("date_et_heure_de_comptage")))


def with_air_zone(df: DataFrame) -> DataFrame:
    return df.withColumn("zone", air_zone(F.col("station")))


def with_traffic_zone(df: DataFrame) -> DataFrame:
    return df.withColumn("zone", traffic_zone(F.col("libelle")))


def _dimension_of(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """A local table, whose size the planner knows and broadcasts by."""
    folded: dict[str, str] = {}
    for label, zone in mapping.items():
        if folded.setdefault(label.lower(), zone) != zone:
            raise ValueError(f"label {label.lower()!r} is mapped to two zones")
    columns = {"label": list(folded), "mapped": list(folded.values())}
    schema = pa.schema([("label", pa.string()), ("mapped", pa.string())])
    return df.sparkSession.createDataFrame(pa.table(columns, schema=schema))


def map_zones(df: DataFrame, mapping: Mapping[str, str] | DataFrame = ZONE_MAPPING) -> DataFrame:
    """Replace `zone` by what its label maps to; unmapped zones stay.

    The mapping is a dict, or a table `(zone, mapped)` of any size. Labels match in lower case, the
    form zones have by then. A label mapped to two zones is an error in either form, for a
    table when the query runs.
    """
    if isinstance(mapping, DataFrame):
        both = mapping.groupBy(F.lower("zone").alias("label")).agg(
            F.min("mapped").alias("low"), F.max("mapped").alias("high")
        )
        error = F.concat(F.lit("label mapped to two zones: "), F.col("label"))
        single = F.when(F.col("low") != F.col("high"), F.raise_error(error)).otherwise(F.col("low"))
        dimension = both.select("label", single.alias("mapped"))
    else:
        dimension = _dimension_of(df, mapping)
    return (
        df.join(dimension, F.col("zone") == F.col("label"), "left")
        .withColumn("zone", F.coalesce("mapped", "zone"))
        .drop("label", "mapped")
    )


def conform_air(
    raw: DataFrame, rules: Mapping[str, str] = AIR_RULES, carried: Sequence[str] = ()
) -> DataFrame:
    """Valid air rows with zone and hour, in the nine silver columns, with columns to be carried."""
    staged = with_air_zone(with_air_hour(valid_air(raw, rules)))
    return staged.select("zone", "hour", *AIR_METRICS, *carried, *DATE_KEYS)


def conform_traffic(
    raw: DataFrame,
    mapping: Mapping[str, str] | DataFrame = ZONE_MAPPING,
    rules: Mapping[str, str] = TRAFFIC_RULES,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Valid traffic rows with mapped zone, hour and a numeric count. The ingest date is kept for
    partitioning only; the silver join does not use it."""
    staged = with_traffic_zone(with_traffic_hour(valid_traffic(raw, rules)))
    return map_zones(staged, mapping).select(
        "zone",
        "hour",
        F.col("debit_horaire").try_cast("double").alias("debit_horaire"),
        *carried,
        *DATE_KEYS,
    )

"""Catalog registration of lake folders."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType
from pyspark.sql.utils import is_remote

from zonalake.operators.pairing import PAIRS_PER_BLOCK
from zonalake.schemas import AIR_METRICS, DATE_KEYS


def _columns(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _drop(spark: SparkSession, name: str) -> None:
    if spark.catalog.tableExists(name):
        kind = spark.catalog.getTable(name).tableType
        if kind == "MANAGED":
            raise ValueError(f"{name} is a table that owns its files")
        is_view = kind == "VIEW"
        spark.sql(f"DROP {'VIEW' if is_view else 'TABLE'} {name}")


def is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"


def _absolute(spark: SparkSession, path: str) -> str:
    """The path as a write resolves it; a table's location would be taken under the warehouse."""
    if is_remote():
        return path if "://" in path else str(Path(path).absolute())
    own = spark._jvm.org.apache.hadoop.fs.Path(path)
    return own.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(own).toString()


def register_table(spark: SparkSession, name: str, path: str, schema: StructType) -> None:
    """External Parquet table over all partitions of `path`, which are ingest dates.

    The table is made anew each time, so it has every date of the folder, whenever it was written,
    and follows a folder that has moved. Dropping leaves the files alone.
    """
    escaped = _absolute(spark, path).replace("'", "\\'")
    _drop(spark, name)
    spark.sql(
        f"CREATE TABLE {name} ({_columns(schema)}) USING PARQUET "
        f"PARTITIONED BY ({', '.join(DATE_KEYS)}) LOCATION '{escaped}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    spark.catalog.refreshTable(name)


#: Blocks of a key of the view, as long as they hold no more than PAIRS_PER_BLOCK pairs.
BLOCKS_PER_KEY = 64


def _blocks(own: str, other: str, pairs: int) -> str:
    """Into how many blocks a key's rows of one side are split (as in `operators.pairing`)."""
    most = max(pairs, PAIRS_PER_BLOCK)
    all_pairs = f"CAST({own} AS DOUBLE) * CAST({other} AS DOUBLE)"
    pairs = f"greatest({pairs}D, least({most}D, {all_pairs} / {BLOCKS_PER_KEY}))"
    side = f"least(CAST({other} AS DOUBLE), sqrt({pairs}))"
    return f"CAST(greatest(1, ceil(CAST({own} AS DOUBLE) * {side} / {pairs})) AS INT)"


def silver_view_sql(air_table: str, traffic_table: str, pairs_per_block: int = PAIRS_PER_BLOCK) -> str:
    """A query with the rows and columns of the joined silver table.

    The join repeats each air row for every traffic row of its zone and hour, so stored it grows
    with the square of the history. As a view it costs nothing until queried; filters on zone and
    hour reach both tables, filters on the date reach the air rows.

    Each key is a grid of blocks, so that a hot key is joined by many tasks: a row falls in one block of
    its own side by its content, and is repeated for each block of the other side. The number of blocks
    follows from a table of both sides' rows per key. Keys of `pairs_per_block` pairs are one block; larger ones have
    about BLOCKS_PER_KEY, so that the copies sent grow with the rows and not with the pairs, and more only where
    blocks would pass PAIRS_PER_BLOCK.
    """
    metrics = ", ".join(f"a.{m}" for m in AIR_METRICS)
    dates = ", ".join(f"a.{d}" for d in DATE_KEYS)
    return f"""
        WITH air AS (
          SELECT zone, hour, sum(pollution_value) AS total, count(pollution_value) AS n, count(*) AS air_rows
          FROM {air_table} GROUP BY zone, hour
        ), traffic AS (
          SELECT zone, hour, count(*) AS n FROM {traffic_table} GROUP BY zone, hour
        ), keys AS (
          SELECT zone, hour,
                 {_blocks("air.air_rows", "traffic.n", pairs_per_block)} AS air_blocks,
                 {_blocks("traffic.n", "air.air_rows", pairs_per_block)} AS traffic_blocks,
                 try_divide(
                   sum(air.total * CAST(traffic.n AS DOUBLE)) OVER upto,
                   sum(air.n * CAST(traffic.n AS DOUBLE)) OVER upto
                 ) AS rolling_avg_pollution
          FROM air JOIN traffic USING (zone, hour)
          WINDOW upto AS (PARTITION BY zone ORDER BY hour)
        ), air_grid AS (
          SELECT a.zone, a.hour, {metrics}, {dates}, k.rolling_avg_pollution,
                 pmod(xxhash64({metrics}, {dates}), k.air_blocks) AS air_block,
                 explode(sequence(0, k.traffic_blocks - 1)) AS traffic_block
          FROM {air_table} a JOIN keys k ON a.zone = k.zone AND a.hour = k.hour
        ), traffic_grid AS (
          SELECT t.zone, t.hour, t.debit_horaire,
                 explode(sequence(0, k.air_blocks - 1)) AS air_block,
                 pmod(xxhash64(t.debit_horaire, t.year, t.month, t.day), k.traffic_blocks) AS traffic_block
          FROM {traffic_table} t JOIN keys k ON t.zone = k.zone AND t.hour = k.hour
        )
        SELECT a.zone, a.hour, {metrics}, {dates}, t.debit_horaire, a.rolling_avg_pollution
        FROM air_grid a
        JOIN traffic_grid t ON a.zone = t.zone AND a.hour = t.hour
          AND a.air_block = t.air_block AND a.traffic_block = t.traffic_block
    """


def create_silver_view(
    spark: SparkSession, name: str, air_table: str, traffic_table: str, pairs_per_block: int = PAIRS_PER_BLOCK
) -> None:
    """View of `silver_view_sql` over two catalog tables."""
    _drop(spark, name)
    spark.sql(f"CREATE VIEW {name} AS {silver_view_sql(air_table, traffic_table, pairs_per_block)}")

"""The three layers as plans over a lake folder.

Layout under the silver folder: `air` and `traffic` hold the conformed sides by ingest date, and
`joined` the row-level join when asked for. Under the gold folder: `air_cells` and `traffic_cells`
hold pre-aggregates by ingest date, and one folder per mart.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zonalake.fixed_values import AIR_RULES, TRAFFIC_RULES, ZONE_MAPPING
from zonalake.operators.cells import (
    air_cells,
    cells_of_silver,
    merge_traffic_cells,
    pair_cells,
    traffic_cells,
)
from zonalake.operators.conform import conform_air, conform_traffic
from zonalake.operators.pairing import PAIRS_PER_BLOCK, silver_join
from zonalake.operators.quality import FAILED, RAW_ROW, REJECTED, checked, rule_counts
from zonalake.operators.staging import drop_reingested, stamp_ingest_date
from zonalake.plans.gold import in_order, pollution_mart, traffic_mart, traffic_pollution_mart
from zonalake.plans.reingest import build_index, rows_of_day
from zonalake.schemas import AIR_TIME, DATE_KEYS, RAW_AIR, RAW_TRAFFIC, SILVER_AIR, SILVER_TRAFFIC, TRAFFIC_TIME
from zonalake.session import settle
from zonalake.sinks import counted, write_day, write_lake
from zonalake.sources import read_lake


def ingest(df: DataFrame, path: str, day: date) -> int:
    """Stamp a batch with its ingest date and write it to the raw layer. No shuffle, and a repeated
    run of one date replaces that date only."""
    return write_day(stamp_ingest_date(df, day), path, day)


def _write(df: DataFrame, path: str, day: date | None, rebalance: bool = False) -> int:
    if day is None:
        return write_lake(df, path, rebalance=rebalance, whole=True)
    return write_day(df, path, day)


def refine(
    spark: SparkSession,
    air_path: str,
    traffic_path: str,
    silver_path: str,
    day: date | None = None,
    mapping: Mapping[str, str] | DataFrame = ZONE_MAPPING,
    drop_duplicates: bool = False,
    report: bool = False,
) -> dict[str, int]:
    """Validate and conform both raw tables into silver. With a date, only its partitions are read
    and replaced; without one, all of silver is. Raw lies by date already, so a task that reads a
    split writes one date, and no row is shuffled.

    `drop_duplicates` keeps of rows that were ingested on several dates those of the earliest. Without a
    date that groups all of raw, and the index of row hashes under the silver folder is built anew. With
    one, the day's rows are held against that index (`plans.reingest`); later dates that keep other rows
    because of it are written too. `report` adds the rows of the date that fail each rule,
    counted by the tasks that write; the rules then cannot reach the scan.
    """
    sides = {
        "air": (air_path, RAW_AIR, AIR_RULES, conform_air, AIR_TIME),
        "traffic": (traffic_path, RAW_TRAFFIC, TRAFFIC_RULES, lambda raw: conform_traffic(raw, mapping), TRAFFIC_TIME),
    }
    rows, failed = {}, {}
    for side, (path, schema, rules, conform, time) in sides.items():
        commit = None
        raw = read_lake(spark, path, schema, day)
        kept = {day: raw}
        if drop_duplicates and day:
            found = rows_of_day(spark, path, f"{silver_path}/{side}_index", schema, time, day)
            kept, commit = found.kept, found.commit
        elif drop_duplicates:
            kept = {None: drop_reingested(raw)}
            build_index(raw, f"{silver_path}/{side}_index", time)
        for date_kept, own in kept.items():
            if report and date_kept == day:
                own, failed[side] = rule_counts(own, side, rules)
            written = _write(conform(own), f"{silver_path}/{side}", date_kept)
            rows[side] = rows.get(side, 0) + written
        if commit:
            commit()
    for side, counts in failed.items():
        rows |= {f"{side}: {rule} failed": n for rule, n in counts.get.items()}
    return rows


def checked_path(silver_path: str, side: str) -> str:
    """Where `refine_with_quarantine` keeps a side: by ingest date, and in it by whether a row was rejected."""
    return f"{silver_path}/{side}_checked"


def checked_sides(
    raw_air: DataFrame, raw_traffic: DataFrame, mapping: Mapping[str, str] | DataFrame = ZONE_MAPPING
) -> dict[str, DataFrame]:
    """Both conformed sides with all their rows: each has the mask of failed rules, and rejected ones the
    raw row."""
    carried = (FAILED, RAW_ROW, REJECTED)
    return {
        "air": conform_air(checked(raw_air, AIR_RULES), {}, carried),
        "traffic": conform_traffic(checked(raw_traffic, TRAFFIC_RULES), mapping, {}, carried),
    }


def refine_with_quarantine(
    spark: SparkSession,
    air_path: str,
    traffic_path: str,
    silver_path: str,
    day: date | None = None,
    mapping: Mapping[str, str] | DataFrame = ZONE_MAPPING,
) -> dict[str, int]:
    """As `refine`, but rows that fail a rule are kept beside the good ones, by one write of one scan.

    The rules cannot reach the scan then. `accepted_rows` and `rejected_rows` read the two kinds.
    """
    raws = read_lake(spark, air_path, RAW_AIR, day), read_lake(spark, traffic_path, RAW_TRAFFIC, day)
    rows = {}
    for side, df in checked_sides(*raws, mapping).items():
        path = checked_path(silver_path, side)
        if day:
            rows[side] = write_day(df, path, day, [REJECTED])
        else:
            rows[side] = write_lake(df, path, keys=[*DATE_KEYS, REJECTED], whole=True)
    return rows


def _by_kind(spark: SparkSession, silver_path: str, side: str, day: date | None, rejected: bool) -> DataFrame:
    silver, raw = (SILVER_AIR, RAW_AIR) if side == "air" else (SILVER_TRAFFIC, RAW_TRAFFIC)
    schema = StructType([*silver.fields]).add(FAILED, "long").add(RAW_ROW, raw).add(REJECTED, "boolean")
    kind = F.col(REJECTED) if rejected else ~F.col(REJECTED)
    return read_lake(spark, checked_path(silver_path, side), schema, day).filter(kind)


def accepted_rows(spark: SparkSession, silver_path: str, side: str, day: date | None = None) -> DataFrame:
    """The rows of a silver side (`air` or `traffic`); files of rejected rows are not read."""
    silver = SILVER_AIR if side == "air" else SILVER_TRAFFIC
    return _by_kind(spark, silver_path, side, day, False).select(*silver.fieldNames())


def rejected_rows(spark: SparkSession, silver_path: str, side: str, day: date | None = None) -> DataFrame:
    """Raw rows that failed a rule, with the mask of the rules (see `quality.rules_of_mask`)."""
    return _by_kind(spark, silver_path, side, day, True).select(f"{RAW_ROW}.*", FAILED)


def silver_sides(
    spark: SparkSession, silver_path: str, day: date | None = None, quarantine: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Both sides; with `quarantine` the accepted rows of what `refine_with_quarantine` wrote."""
    if quarantine:
        return tuple(accepted_rows(spark, silver_path, side, day) for side in ("air", "traffic"))
    return (
        read_lake(spark, f"{silver_path}/air", SILVER_AIR, day),
        read_lake(spark, f"{silver_path}/traffic", SILVER_TRAFFIC, day),
    )


def join_silver(
    spark: SparkSession, silver_path: str, pairs_per_block: int = PAIRS_PER_BLOCK
) -> int:
    """Write the row-level join. Its size is the product of both sides per zone and hour, summed;
    gold does not need it."""
    air, traffic = silver_sides(spark, silver_path)
    joined = silver_join(air, traffic, pairs_per_block)
    return write_lake(joined, f"{silver_path}/joined", rebalance=True, whole=True)


def refresh_cells(
    air: DataFrame, traffic: DataFrame, gold_path: str, day: date | None = None
) -> None:
    """Pre-aggregate both silver sides by ingest date. With a date, the sides hold that date and
    only that date is replaced."""
    _write(air_cells(air), f"{gold_path}/air_cells", day, rebalance=True)
    _write(traffic_cells(traffic, by_date=True), f"{gold_path}/traffic_cells", day, rebalance=True)


def stored_cells(spark: SparkSession, gold_path: str) -> DataFrame:
    """Paired cells from the stored ones. These tables hold at most 24 rows per zone and date."""
    air = read_lake(spark, f"{gold_path}/air_cells")
    traffic = read_lake(spark, f"{gold_path}/traffic_cells")
    return pair_cells(air, merge_traffic_cells(traffic))


def marts_of_cells(cells: DataFrame) -> dict[str, DataFrame]:
    return {
        "datamart_pollution": pollution_mart(cells),
        "datamart_traffic": traffic_mart(cells),
        "datamart_traffic_pollution": traffic_pollution_mart(cells),
    }


def settled_silver_cells(silver: DataFrame) -> DataFrame:
    """Paired cells from a joined silver table, such as one named in the catalog. The table is read
    once; all marts share the settled result."""
    return settle(cells_of_silver(silver), "silver-cells")


def write_marts(marts: Mapping[str, DataFrame], gold_path: str) -> dict[str, int]:
    """Replace each mart's folder, in the mart's order, and return the rows written. Marts are whole
    tables, so they have no partitions to keep; while one is replaced its folder is incomplete."""
    rows = {}
    for name, mart in marts.items():
        out, metric = counted(in_order(name, mart))
        out.write.mode("overwrite").parquet(f"{gold_path}/{name}")
        rows[name] = metric.get.get("rows", 0)
    return rows


def read_marts(spark: SparkSession, gold_path: str) -> dict[str, DataFrame]:
    names = ["datamart_pollution", "datamart_traffic", "datamart_traffic_pollution"]
    return {name: spark.read.parquet(f"{gold_path}/{name}") for name in names}

"""Removal of rows that came again, a day at a time, against a stored index of row hashes.

The result over all dates is that of `staging.drop_reingested` over all of raw: of rows that are equal
but for the ingest date, the one of the earliest date stays. A day reads its own raw rows and the parts
of the index that they touch. A date that is ingested late, or again with other rows, changes which
later dates keep a row; those dates are named, so that they are renewed too.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zonalake.operators.rowindex import (
    ENTRY,
    day_number,
    first_rows,
    index_entries,
    moved_dates,
    number_of,
)
from zonalake.schemas import DATE_KEYS
from zonalake.session import path_exists, settle
from zonalake.sinks import write_day, write_lake
from zonalake.sources import read_lake
from zonalake.sources.files import on_date

_DATE = re.compile(r"/year=(\d+)/month=(\d+)/day=(\d+)(?:/part=(\d+))?/")


@dataclass
class DayRows:
    """What a day's run has to write: the rows that each date keeps, and the index when that is done."""

    kept: dict[date, DataFrame]
    commit: Callable[[], None]


def _read(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _files(df: DataFrame) -> Iterable[tuple[date, int]]:
    """Date and part of each file, from the listing alone."""
    for file in df.inputFiles():
        found = _DATE.search(file)
        if found:
            year, month, day, part = found.groups()
            yield date(int(year), int(month), int(day)), int(part or 0)


def stored_dates(df: DataFrame) -> set[date]:
    return {day for day, _ in _files(df)}


def build_index(raw: DataFrame, index_path: str, locality: str, whole: bool = True) -> None:
    """Write the entries of `raw`, in place of the whole index or else of dates that it lacks."""
    write_lake(index_entries(raw, locality), index_path, keys=[*DATE_KEYS, "part"], whole=whole)


def _in_dates(df: DataFrame, days: Iterable[date]) -> DataFrame:
    return df.filter(day_number().isin([number_of(day) for day in days]))


def rows_of_day(
    spark: SparkSession, raw_path: str, index_path: str, schema: StructType, locality: str, day: date
) -> DayRows:
    """The rows that `day` keeps, and those of later dates that have to be renewed.

    Dates of raw that the index lacks are entered first, each read once. The index of `day` is written by
    `commit`, after its rows: a run that fails before can be repeated.
    """
    raw = read_lake(spark, raw_path, schema)
    missing = stored_dates(raw) - stored_dates(_read(spark, index_path, ENTRY)) - {day}
    if missing:
        build_index(_in_dates(raw, missing), index_path, locality, whole=False)
    index = _read(spark, index_path, ENTRY)
    files = list(_files(index))
    new = settle(index_entries(on_date(raw, day), locality), "row-entries")
    own = day_number() == number_of(day)
    touched = {row.part for row in new.select("part").distinct().collect()}  # rowindex.PARTS at most

    def earlier(other: date, parts: set[int]) -> DataFrame:
        stored = index.filter(F.col("part").isin(sorted(parts)) & (day_number() < number_of(other)) & ~own)
        return stored.unionByName(new) if day < other else stored

    kept = {day: first_rows(on_date(raw, day), earlier(day, touched), locality)}
    if any(stored > day for stored, _ in files):
        changed_parts = touched | {part for stored, part in files if stored == day}
        others = index.filter(F.col("part").isin(sorted(changed_parts)) & ~own)
        for row in moved_dates(new, index.filter(own), others, day).collect():  # a row a date
            number = row.changed
            other = date(number // 10_000, number // 100 % 100, number % 100)
            parts = {part for stored, part in files if stored == other}
            kept[other] = first_rows(on_date(raw, other), earlier(other, parts), locality)

    def commit() -> None:
        folder = f"{index_path}/year={day.year}/month={day.month}/day={day.day}"
        new.drop(*DATE_KEYS).write.mode("overwrite").partitionBy("part").parquet(folder)

    return DayRows(kept, commit)


def refresh_first_rows(
    spark: SparkSession, raw_path: str, index_path: str, path: str, schema: StructType, locality: str, day: date
) -> list[date]:
    """Write the rows that `day` keeps, and those of later dates that change with it, by date under
    `path`; returns the dates."""
    found = rows_of_day(spark, raw_path, index_path, schema, locality, day)
    for own, rows in found.kept.items():
        write_day(rows, path, own)
    found.commit()
    return sorted(found.kept)

"""An index of row hashes by ingest date, which tells rows that came again without reading old rows.

An entry is the 128-bit hash of a row's source columns with the date it was ingested on. Entries lie by
date and by `part`, a hash of the row's locality (its observation date). A row that comes again has the
same locality, so a day's batch, which covers few observation dates, touches few parts of the index.

Different rows share a hash with a probability of n^2 / 2^129 for n rows: 1e-14 for 1e12 rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonalake.schemas import DATE_KEYS

PARTS = 1024
HASH = ["row_low", "row_high"]
ENTRY = f"{HASH[0]} bigint, {HASH[1]} bigint, year int, month int, day int, part int"
_SEEDS = (1, 0x5BD1E995)


def day_number() -> Column:
    """The ingest date as one ordered number."""
    return F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")


def number_of(day: date) -> int:
    return day.year * 10_000 + day.month * 100 + day.day


def with_row_hash(df: DataFrame, locality: str) -> DataFrame:
    """`df` with the hash of its source columns and its part of the index. Spark's hash passes over
    NULL, so each column is followed by whether it is one."""
    source = [c for c in df.columns if c not in DATE_KEYS]
    marked = [x for c in source for x in (F.col(c), F.col(c).isNull())]
    hashes = {name: F.xxhash64(F.lit(seed), *marked) for name, seed in zip(HASH, _SEEDS, strict=True)}
    part = F.pmod(F.xxhash64(F.substring(F.col(locality).cast("string"), 1, 10)), F.lit(PARTS))
    return df.withColumns(hashes | {"part": part.cast("int")})


def index_entries(raw: DataFrame, locality: str) -> DataFrame:
    """The distinct entries of raw rows. Copies combine in the map tasks."""
    return with_row_hash(raw, locality).select(*HASH, *DATE_KEYS, "part").distinct()


def first_rows(rows: DataFrame, earlier: DataFrame, locality: str) -> DataFrame:
    """One of each set of equal rows of one date, without those that `earlier` entries have.

    Rows meet the entries by the hash by which they are also grouped, so they are shuffled once.
    """
    hashed = with_row_hash(rows, locality).dropDuplicates(HASH)
    return hashed.join(earlier.select(*HASH), HASH, "left_anti").select(*rows.columns)


def moved_dates(new: DataFrame, old: DataFrame, others: DataFrame, day: date) -> DataFrame:
    """Dates whose first rows change when a date's entries change from `old` to `new`: (changed).

    A row that came or went on that date counts on the next date that has it, unless an earlier one has
    it too. `others` are the entries of all other dates.
    """
    sides = [entries.select(*HASH, F.lit(x).alias("side")) for entries, x in ((new, 1), (old, -1))]
    moved = sides[0].unionByName(sides[1]).groupBy(*HASH).agg(F.sum("side").alias("side")).filter("side != 0")
    first = others.join(moved, HASH, "left_semi").groupBy(*HASH).agg(F.min(day_number()).alias("changed"))
    return first.filter(F.col("changed") > number_of(day)).select("changed").distinct()

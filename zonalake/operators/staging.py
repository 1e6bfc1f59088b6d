"""Raw layer: ingest date and duplicate removal."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from zonalake.schemas import DATE_KEYS


def stamp_ingest_date(df: DataFrame, day: date) -> DataFrame:
    """Add the ingest date as integer columns."""
    return df.withColumns(
        {"year": F.lit(day.year), "month": F.lit(day.month), "day": F.lit(day.day)}
    )


def cast_known(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns named in `schema` in its types, all others as they are. A database may deliver
    decimals or floats; the raw layer has one type per column."""
    known = {f.name: F.col(f.name).cast(f.dataType) for f in schema.fields if f.name in df.columns}
    return df.withColumns(known)


def drop_duplicate_rows(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One of each set of equal rows, or of rows equal in `keys`.

    Copies collapse inside each map task before the shuffle, so a row that makes up a large part
    of the table does not load one reducer.
    """
    return df.dropDuplicates(keys) if keys else df.dropDuplicates()


def drop_reingested(df: DataFrame) -> DataFrame:
    """One of each set of rows that are equal but for the ingest date: that of the earliest date.

    A batch that is ingested again on another date gives such rows. Copies combine in the map tasks.
    """
    source = [c for c in df.columns if c not in DATE_KEYS]
    day = F.col("year") * 10_000 + F.col("month") * 100 + F.col("day")
    first = df.groupBy(*source).agg(F.min(day).alias("__day"))
    parts = {
        "year": F.floor(F.col("__day") / 10_000),
        "month": F.floor(F.col("__day") / 100) % 100,
        "day": F.col("__day") % 100,
    }
    dated = first.withColumns({name: part.cast("int") for name, part in parts.items()})
    return dated.select(*df.columns)

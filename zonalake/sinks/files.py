"""Parquet sinks and row-count metrics."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from zonalake.schemas import DATE_KEYS


def counted(df: DataFrame, name: str = "written") -> tuple[DataFrame, Observation]:
    """`df` with a row count that the next action fills in, so counting needs no pass of its own."""
    metric = Observation(name)
    return df.observe(metric, F.count(F.lit(1)).alias("rows")), metric


def write_lake(
    df: DataFrame,
    path: str,
    keys: list[str] | None = None,
    rebalance: bool = False,
    whole: bool = False,
) -> int:
    """Write `df` by partition and return the rows written.

    Partitions present in `df` are replaced and all others kept; `whole` replaces the table. For
    many dates at once, `rebalance` gathers rows by partition so that each gets few files, and
    adaptive execution splits the large ones.
    """
    keys = DATE_KEYS if keys is None else keys
    # Counted after the shuffle, in the tasks that write, so that a map task that runs again does
    # not count twice.
    out, metric = counted(df.hint("rebalance", *keys) if rebalance else df)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    return metric.get.get("rows", 0)


def write_day(df: DataFrame, path: str, day: date, keys: list[str] | None = None) -> int:
    """Replace the partition of one ingest date, laid out by `keys` inside, and return the rows written.
    Needs no shuffle, and a batch without rows empties the partition rather than leaving old rows in it."""
    out, metric = counted(df.drop(*DATE_KEYS))
    partition = f"{path}/year={day.year}/month={day.month}/day={day.day}"
    out.write.mode("overwrite").partitionBy(*keys or ()).parquet(partition)
    return metric.get.get("rows", 0)

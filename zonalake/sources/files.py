"""File and catalog scans."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_traffic_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, sep: str = ","
) -> DataFrame:
    """CSV with a header, all columns as text.

    Without a schema the header names the columns, so unknown columns are carried along. With one,
    no job is needed to read the header, and a header that disagrees fails the read.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def on_date(df: DataFrame, day: date | None) -> DataFrame:
    """Only the partition of one ingest date; every date when `day` is None."""
    if day is None:
        return df
    return df.filter(
        (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
    )


def read_lake(
    spark: SparkSession, path: str, schema: StructType | None = None, day: date | None = None
) -> DataFrame:
    """Parquet by ingest date. A schema saves the job that infers it; a date prunes partitions."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return on_date(reader.parquet(path), day)


def read_table(spark: SparkSession, name: str, day: date | None = None) -> DataFrame:
    """A catalog table, optionally one ingest date of it."""
    return on_date(spark.table(name), day)

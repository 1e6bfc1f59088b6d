"""JDBC table scan."""

from __future__ import annotations

import os
from collections.abc import Iterable
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

USER_VARIABLE = "ZONALAKE_JDBC_USER"
PASSWORD_VARIABLE = "ZONALAKE_JDBC_PASSWORD"
DEFAULT_DRIVER = "org.mariadb.jdbc.Driver"


def connection_options(
    url: str,
    table: str,
    driver: str = DEFAULT_DRIVER,
    user: str | None = None,
    password: str | None = None,
) -> dict[str, str]:
    """Options common to reads and writes. Credentials default to the environment, so they need
    not be on a command line."""
    options = {"url": url, "dbtable": table, "driver": driver}
    user = user if user is not None else os.environ.get(USER_VARIABLE)
    password = password if password is not None else os.environ.get(PASSWORD_VARIABLE)
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    return options


def jdbc_read_options(
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **connection: str,
) -> dict[str, str]:
    """Read options. With a partition column, the table is read over several connections; the
    bounds only shape the split, rows outside them are read too."""
    options = connection_options(url, table, **connection) | {"fetchsize": str(fetch_size)}
    split = (partition_column, lower_bound, upper_bound, partitions)
    if all(part is None for part in split):
        return options
    if any(part is None for part in split):
        raise ValueError("a split read needs column, lower bound, upper bound and partitions")
    return options | {
        "partitionColumn": str(partition_column),
        "lowerBound": str(lower_bound),
        "upperBound": str(upper_bound),
        "numPartitions": str(partitions),
    }


def bounds_query(table: str, column: str) -> str:
    """Smallest and largest value of the column a read is split by."""
    return f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {table}"


def quantiles_query(table: str, column: str, partitions: int) -> str:
    """The largest value of each of `partitions` lots of equally many rows, in ascending order.

    The database ranks the whole column, from its index where there is one; a row a lot comes back.
    """
    return (
        f"SELECT tile, MAX(v) AS upto FROM (SELECT {column} AS v, NTILE({int(partitions)}) OVER (ORDER BY {column}) "
        f"AS tile FROM {table} WHERE {column} IS NOT NULL) lots GROUP BY tile"
    )


def _literal(value: object) -> str | None:
    """A value as SQL that all databases read alike; None where there is no such form."""
    if isinstance(value, bool):
        return None
    if isinstance(value, int | Decimal):
        return str(value) if not isinstance(value, Decimal) or value.is_finite() else None
    if isinstance(value, float):
        return repr(value) if value - value == 0 else None
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value:%Y-%m-%d %H:%M:%S.%f}'"
    if isinstance(value, date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, str) and "\\" not in value and value.isprintable():
        return "'" + value.replace("'", "''") + "'"
    return None


def split_predicates(column: str, upto: Iterable[object]) -> list[str]:
    """Conditions that every row of a table meets exactly one of, one for each connection.

    `upto` are split points in the order of the database, whose own comparison decides, so its collation
    does no harm. The last lot has no upper end, so rows that come in meanwhile are read too; NULL goes
    with the first. Equal points count once: rows of one value are not split. A point without a literal
    that all databases read alike is left out, which joins two lots.
    """
    points = list(dict.fromkeys(p for p in map(_literal, upto) if p is not None))[:-1]
    if not points:
        return ["1 = 1"]
    first, *rest = points
    between = [f"{column} > {low} AND {column} <= {high}" for low, high in zip(points, rest, strict=False)]
    return [f"{column} <= {first} OR {column} IS NULL", *between, f"{column} > {points[-1]}"]


def read_jdbc(spark: SparkSession, url: str, table: str, *, balanced: bool = True, **options) -> DataFrame:
    """A database table with the column types the database reports.

    With a partition column and a number of partitions but no bounds, the connections read lots of about
    equally many rows, whose ends one query asks the database for. Without `balanced` that query asks for
    the smallest and the largest value only, and the lots are equally wide. An empty table is read in
    one piece.
    """
    column, low, high = (options.get(n) for n in ("partition_column", "lower_bound", "upper_bound"))
    partitions = options.get("partitions")
    if column and partitions and low is None and high is None:
        names = ("driver", "user", "password")
        connection = connection_options(url, table, **{n: options[n] for n in names if n in options})
        connection.pop("dbtable")
        reader = spark.read.format("jdbc").options(**connection)
        options |= {"partition_column": None, "partitions": None}
        if balanced:
            lots = reader.option("query", quantiles_query(table, column, partitions)).load().collect()
            found = split_predicates(column, [r[1] for r in sorted(lots, key=lambda r: r[0])])
            properties = jdbc_read_options(url, table, **options)
            del properties["url"], properties["dbtable"]
            return spark.read.jdbc(url, table, predicates=found, properties=properties)
        low, high = reader.option("query", bounds_query(table, column)).load().first()
        if low is not None:
            options |= {"partition_column": column, "partitions": partitions}
            options |= {"lower_bound": str(low), "upper_bound": str(high)}
    return spark.read.format("jdbc").options(**jdbc_read_options(url, table, **options)).load()

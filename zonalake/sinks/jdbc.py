"""JDBC table sink."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonalake.session import settle
from zonalake.sources.jdbc import connection_options

#: The column of a staging table that tells a row written twice from two equal rows.
ROW_NUMBER = "zonalake_row"


def jdbc_write_options(
    url: str, table: str, *, connections: int = 1, batch_size: int = 10_000, **connection: str
) -> dict[str, str]:
    """Write options. `truncate` keeps the table's own column types and indexes on overwrite."""
    return connection_options(url, table, **connection) | {
        "truncate": "true",
        "numPartitions": str(connections),
        "batchsize": str(batch_size),
    }


def write_jdbc(df: DataFrame, url: str, table: str, **options) -> None:
    """Replace the rows of a database table. Marts are small, so one connection is the default;
    each connection's rows are one transaction."""
    df.write.format("jdbc").options(**jdbc_write_options(url, table, **options)).mode(
        "overwrite"
    ).save()


def swap_statements(
    table: str, stage: str, columns: Sequence[str], quote: Callable[[str], str] = '"{}"'.format
) -> list[str]:
    """What replaces the rows of `table` by those of a staging table, each of its rows once."""
    names = ", ".join(map(quote, columns))
    once = f"SELECT DISTINCT {names}, {quote(ROW_NUMBER)} FROM {stage}"
    return [f"DELETE FROM {table}", f"INSERT INTO {table} ({names}) SELECT {names} FROM ({once}) staged"]


def in_one_transaction(connection, statements: Sequence[str]) -> None:
    """Run statements on a `java.sql.Connection`: all of them take effect, or none."""
    connection.setAutoCommit(False)
    try:
        for statement in statements:
            connection.createStatement().executeUpdate(statement)
        connection.commit()
    except Exception:
        connection.rollback()
        raise


def write_jdbc_staged(df: DataFrame, url: str, table: str, **options) -> None:
    """As `write_jdbc`, but a task that runs again after a lost executor doubles no row, and readers see
    the old rows or the new ones, never a part.

    Rows are written to the shared folder first, so that a task that runs again writes the same rows with
    the same numbers. They go to a staging table with a name of this run; one transaction then replaces the
    rows of the table, and the staging table is dropped. A run that fails leaves the table as it was.
    """
    spark = df.sparkSession
    jvm = spark._jvm
    rows = settle(df, "jdbc-rows")
    stage = f"{table}_{uuid.uuid4().hex[:12]}"
    target = jdbc_write_options(url, table, **options)
    # Appending nothing makes the table if there is none.
    rows.limit(0).write.format("jdbc").options(**target).mode("append").save()

    jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(target["driver"])
    properties = jvm.java.util.Properties()
    for name in {"user", "password"} & target.keys():
        properties.setProperty(name, target[name])
    quote = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        numbered = rows.withColumn(ROW_NUMBER, F.monotonically_increasing_id())
        staged = jdbc_write_options(url, stage, **options)
        numbered.write.format("jdbc").options(**staged).mode("errorifexists").save()
        in_one_transaction(connection, swap_statements(table, stage, rows.columns, quote))
    finally:
        connection.setAutoCommit(True)
        connection.createStatement().executeUpdate(f"DROP TABLE IF EXISTS {stage}")
        connection.close()

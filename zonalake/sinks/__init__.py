"""Sinks: Parquet by ingest date, catalog tables and views, JDBC tables."""

from zonalake.sinks.catalog import create_silver_view, is_view, register_table, silver_view_sql
from zonalake.sinks.files import counted, write_day, write_lake
from zonalake.sinks.jdbc import (
    in_one_transaction,
    jdbc_write_options,
    swap_statements,
    write_jdbc,
    write_jdbc_staged,
)

__all__ = [
    "counted",
    "create_silver_view",
    "in_one_transaction",
    "is_view",
    "jdbc_write_options",
    "register_table",
    "silver_view_sql",
    "swap_statements",
    "write_day",
    "write_jdbc",
    "write_jdbc_staged",
    "write_lake",
]

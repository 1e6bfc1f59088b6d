"""Sources: CSV, Parquet, catalog tables and JDBC tables."""

from zonalake.sources.files import read_lake, read_table, read_traffic_csv
from zonalake.sources.jdbc import (
    bounds_query,
    jdbc_read_options,
    quantiles_query,
    read_jdbc,
    split_predicates,
)

__all__ = [
    "jdbc_read_options",
    "bounds_query",
    "quantiles_query",
    "read_jdbc",
    "read_lake",
    "read_table",
    "read_traffic_csv",
    "split_predicates",
]

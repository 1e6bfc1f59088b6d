"""Queries over the test tables, and the SQL that each must agree with."""

from zonalake.registry.oracle import oracle_sql
from zonalake.registry.queries import queries

__all__ = ["oracle_sql", "queries"]

"""Name -> query and name -> SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    operators: str


QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, operators: str, sql: str | None = None):
    """Register a query under its name, with the inventory rows it covers and its SQL."""

    def register(run):
        QUERIES[name] = Query(run, operators)
        if sql is not None:
            SQL[name] = sql
        return run

    return register

"""Queries over the driver's tables and their DuckDB equivalents."""

from __future__ import annotations

import importlib
import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query by its function's name, with the SQL that gives the same rows."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = textwrap.dedent(sql).strip()
        return f

    return add


for _name in ("observation", "composite", "joins", "grids", "inventory", "fleet", "text", "areas", "accounts"):
    importlib.import_module(f"thermaquilt.queries.{_name}")

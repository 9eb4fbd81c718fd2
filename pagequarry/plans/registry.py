"""Where queries register beside their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(*tables: str, sql: str | None = None):
    """Registers a function of these tables under its own name."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[f.__name__] = lambda spark, folder: f(*[table(spark, folder, t) for t in tables])
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register

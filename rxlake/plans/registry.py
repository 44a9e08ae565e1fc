"""Named query registry: ``name -> (spark builder, DuckDB oracle SQL)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register a ``(spark, sf_dir) -> DataFrame`` query.

    ``sql`` is the DuckDB equivalent over the driver tables; omit it only for
    iterative / model-fitting operators that SQL cannot express.
    """

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco

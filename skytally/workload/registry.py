"""Registered queries with their check in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from .sql import over_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: bool = True):
    """Register ``fn(spark, sf_dir)``; ``sql`` is the same result for an independent engine."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(tune(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = over_views(sql) if views else sql
        return fn

    return add

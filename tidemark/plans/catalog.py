"""Registry of named queries: Spark implementation + independent SQL oracle.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver's whole tables (through the proxies in ``tidemark.sources.proxies``).
``ORACLE[name]`` is the same result written as DuckDB SQL over the raw views;
queries with no SQL form (model fit, streaming) have no oracle entry.
"""

from __future__ import annotations

from collections.abc import Callable

import functools

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import ship_package
from tidemark.sources.scope import reset

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            reset()
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from tidemark.plans import (  # noqa: F401
        queries_features,
        queries_io,
        queries_landing,
        queries_layers,
        queries_loads,
        queries_ml,
        queries_silver,
    )

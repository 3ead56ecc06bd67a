"""Readers for the driver's parquet tables (the raw inputs the proxies derive from)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import ensure_utc
from tidemark.sources.scope import shared

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; callers select columns so only those are read."""
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown table {name!r}")
    ensure_utc(spark)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return shared(("table", id(spark), path), lambda: spark.read.parquet(path))

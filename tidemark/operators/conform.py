"""Standardise landing frames to a declared schema (STD1-STD6)."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import null_token, truncate
from tidemark.schemas import NULL_TOKENS

log = logging.getLogger(__name__)


def conform(df: DataFrame, columns: Sequence[str], *, upper: bool = False) -> DataFrame:
    """STD1/STD5: match names case-insensitively, keep the declared columns in
    declared order, add missing ones as NULL (with a warning), drop extras."""
    by_lower = {c.lower(): c for c in df.columns}
    missing = [c for c in columns if c.lower() not in by_lower]
    if missing:
        log.warning("columns missing, filled with NULL: %s", missing)
    out = []
    for c in columns:
        name = c.upper() if upper else c
        src = by_lower.get(c.lower())
        out.append((F.col(f"`{src}`") if src else F.lit(None).cast("string")).alias(name))
    return df.select(*out)


def standardise(df: DataFrame, columns: Sequence[str], tokens: Sequence[str] = ("nan", "NaN", "None", "<NA>"),
                max_len: int = 16000) -> DataFrame:
    """STD1-STD4 in one projection: conform, exact-match null tokens, to text, cap length."""
    conf = conform(df, columns)
    return conf.select(*[
        truncate(F.when(F.col(c).cast("string").isin(list(tokens)), F.lit(None)).otherwise(F.col(c).cast("string")),
                 max_len).alias(c)
        for c in conf.columns
    ])


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """STD5 against a target ``StructType``: order, add missing, drop extra, cast."""
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        cols.append((F.col(f"`{src}`") if src else F.lit(None)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """STD6: raise when a required column is absent (case-insensitive); extras are fine."""
    have = {c.lower() for c in df.columns}
    missing = [c for c in columns if c.lower() not in have]
    if missing:
        raise ValueError(f"missing columns {missing}; file has {sorted(df.columns)}")


def replace_null_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Case-insensitive token guard on every string column."""
    return df.select(*[
        null_token(c, tokens).alias(c) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)
        for c in df.columns
    ])

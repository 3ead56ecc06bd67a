"""Bronze -> silver: partition filter, latest load per key, guarded casts, audit (PRJ*, AGG1).

One table-driven function serves all 15 feeds (``tidemark.schemas.FEEDS``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import typed
from tidemark.operators.dedupe import latest_loaded
from tidemark.schemas import AUDIT_COLUMNS, NULL_TOKENS, feed


def with_audit(df: DataFrame, job: str, batch_date: str | dt.date | None, user: str | None = None,
               at: str | None = None) -> DataFrame:
    """PRJ6: created/updated stamps + batch date.  ``at``/``user`` may be pinned
    (tests, replays); by default the query's timestamp and session user."""
    ts = F.lit(at).cast("timestamp") if at else F.current_timestamp()
    who = F.lit(user) if user else F.current_user()
    bd = F.lit(str(batch_date)).cast("date") if batch_date else F.lit(None).cast("date")
    return df.select(
        "*", ts.alias("created_at"), F.lit(job).alias("created_by_job"), who.alias("created_by"),
        ts.alias("updated_at"), F.lit(job).alias("updated_by_job"), who.alias("updated_by"), bd.alias("batch_date"),
    )


def only_partition(df: DataFrame, part_key: str | None, col: str = "part_key") -> DataFrame:
    """PRJ8: restrict bronze to one load partition (pruned at the scan)."""
    return df if part_key is None else df.where(F.col(col) == part_key)


def up_to_batch(df: DataFrame, batch_date: str | dt.date | None, col: str = "batch_date") -> DataFrame:
    """PRJ9: history filter ``batch_date <= d``."""
    return df if batch_date is None else df.where(F.col(col) <= F.lit(str(batch_date)).cast("date"))


def cast_feed(df: DataFrame, name: str, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Typed silver columns for a feed (no dedupe, no audit)."""
    f = feed(name)
    cols = []
    for c, code in f.columns:
        col = typed(c, code, tokens)
        if c in f.fallbacks:
            col = F.coalesce(col, typed(f.fallbacks[c], dict(f.columns)[f.fallbacks[c]], tokens))
        cols.append(col.alias(c))
    return df.select(*cols)


def to_silver(bronze: DataFrame, name: str, *, job: str = "silver", batch_date=None, part_key: str | None = None,
              tokens: Sequence[str] = NULL_TOKENS, audit: bool = True, user: str | None = None,
              at: str | None = None) -> DataFrame:
    f = feed(name)
    latest = latest_loaded(only_partition(bronze, part_key), list(f.keys))
    typed_df = cast_feed(latest, name, tokens)
    if not audit:
        return typed_df
    return with_audit(typed_df, job, batch_date, user=user, at=at)


def business_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in AUDIT_COLUMNS])

"""Top-1 per key (AGG1, AGG2, AGG13, SO4) and latest non-null (NRM12).

``row_number() == 1`` over ``partitionBy(keys)`` is planned by Spark as a
``WindowGroupLimit`` *before* the shuffle, so each map task forwards at most
one row per key: a key holding a third of all rows costs its map tasks a
local top-1, not a single reducer holding the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per ``keys`` under ``order`` (give a total order to be deterministic)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).where(F.col(_RN) == 1).drop(_RN)


def latest_loaded(df: DataFrame, keys: Sequence[str], loaded_at: str = "loaded_at",
                  tie_break: Sequence[str] = ("src_file", "src_row")) -> DataFrame:
    """Newest load per business key (bronze -> silver dedupe).  Ties on the load
    time are broken by source file then row number, so re-runs are stable (D16)."""
    order = [F.col(loaded_at).desc()] + [F.col(c).desc() for c in tie_break if c in df.columns]
    return latest_by(df, keys, order)


def latest_non_null(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], value: str) -> DataFrame:
    """Newest record per key whose ``value`` is not NULL (NRM12)."""
    return latest_by(df.where(F.col(value).isNotNull()), keys, order)

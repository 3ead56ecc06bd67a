"""Small column / frame helpers named in the inventory (SRC5, PRJ7, PRJ10-PRJ16, AGG11, AGG12)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def variant_col(x: str | Column) -> Column:
    """SRC5: semi-structured text kept queryable: JSON text -> VARIANT (NULL when invalid)."""
    return F.try_parse_json(_c(x).cast("string"))


def variant_field(v: str | Column, path: str, dtype: str = "string") -> Column:
    """Typed field of a VARIANT column, e.g. ``variant_field('props', '$.k', 'int')``."""
    return F.try_variant_get(_c(v), path, dtype)


def batch_lit(d: str | dt.date) -> Column:
    """PRJ7: typed batch-date literal."""
    return F.lit(str(d)).cast("date")


def series(df: DataFrame, name_col: str, value: str) -> DataFrame:
    """PRJ10: one named series."""
    return df.where(F.col(name_col) == value)


def matches_all(x: str | Column, patterns: Sequence[str]) -> Column:
    """PRJ11: every LIKE pattern matches."""
    cond = None
    for p in patterns:
        cond = _c(x).like(p) if cond is None else cond & _c(x).like(p)
    return cond


def matches_any_upper(x: str | Column, patterns: Sequence[str]) -> Column:
    """PRJ11: ``UPPER(x) LIKE p`` for any pattern."""
    up = F.upper(_c(x))
    cond = None
    for p in patterns:
        cond = up.like(p) if cond is None else cond | up.like(p)
    return cond


def ratio(n: str | Column, d: str | Column, guard: str = "nonzero", minus1: bool = False) -> Column:
    """PRJ12: guarded ratio; ``guard`` is 'nonzero' or 'positive'."""
    n, d = _c(n), _c(d)
    ok = d > 0 if guard == "positive" else d != 0
    v = n / d
    return F.when(ok, v - 1 if minus1 else v)


def safe_div(n: str | Column, d: str | Column) -> Column:
    """PRJ13: NULL instead of a division-by-zero error (ANSI mode)."""
    return F.try_divide(_c(n), _c(d))


def placeholder(name: str, dtype: str) -> Column:
    """PRJ14: typed NULL column."""
    return F.lit(None).cast(dtype).alias(name)


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ15: drop rows with a NULL in any of ``cols``."""
    return df.dropna(subset=list(cols))


def fill0(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ16: NULL features -> 0."""
    return df.fillna(0.0, subset=list(cols))


def row_count(df: DataFrame) -> tuple[DataFrame, Observation]:
    """AGG11: count rows while the frame is consumed by its real action (no extra scan)."""
    obs = Observation("row_count")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def keys_on(df: DataFrame, day: str | dt.date, key: str = "ticker", date_col: str = "trading_date") -> DataFrame:
    """AGG12: distinct keys present on one date, sorted."""
    return df.where(F.col(date_col) == batch_lit(day)).select(key).distinct().orderBy(key)

"""Banded incremental refresh of the price-driven features.

When new trading days arrive, a row's features can change only if one of its
windows reaches a new row: backward windows (lags, moving averages, volatility)
from the first new row on, forward labels from ``ahead`` rows before it.  Per
touched ticker the job therefore

* finds the first new day (one row per touched ticker),
* takes the ``ahead + back`` rows before it (``back`` = longest backward window) and all from it on,
* recomputes momentum + labels on that slice and keeps the rows from ``ahead`` before it,
* upserts that band into the stored feature table by (ticker, trading_date).

Untouched tickers never reach a window, and ``refresh(part=...)`` rewrites touched
partitions only, so a daily batch costs O(touched tickers x (back + ahead + new
rows)) instead of the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.upsert import upsert, upsert_partitions
from tidemark.plans import marts
from tidemark.session import small_side

KEYS = ["ticker", "trading_date"]
BACK = 200   # longest backward window of the momentum mart (200-row moving average)
AHEAD = 20   # longest forward label (20-row forward return)


def price_features(prices: DataFrame, index: DataFrame) -> DataFrame:
    """Momentum mart + forward labels on (ticker, trading_date)."""
    return marts.momentum_mart(prices, index, labels=True)


def refresh_band(prices: DataFrame, index: DataFrame, new_keys: DataFrame, back: int = BACK,
                 ahead: int = AHEAD) -> DataFrame:
    """Recomputed feature rows for the band the new keys can change.

    Prices are cut to touched tickers before any window; of those, the rows before
    the first new day that can matter are the newest ``back + ahead``."""
    first_new = small_side(new_keys.groupBy("ticker").agg(F.min("trading_date").alias("__first")))
    touched = prices.join(first_new, "ticker")
    older = touched.where(F.col("trading_date") < F.col("__first"))
    newest = Window.partitionBy("ticker").orderBy(F.col("trading_date").desc())
    # a row limit per key, so each task keeps no more than the band's history
    older = older.withColumn("__back", F.row_number().over(newest)).where(F.col("__back") <= back + ahead)
    newer = touched.where(F.col("trading_date") >= F.col("__first")).withColumn("__back", F.lit(0))
    sliced = older.unionByName(newer)
    keep = sliced.where(F.col("__back") <= ahead).select(*KEYS)
    feats = price_features(sliced.drop("__first", "__back"), index)
    return feats.join(keep, KEYS, "left_semi")


def refresh(old_features: DataFrame, prices: DataFrame, index: DataFrame, new_keys: DataFrame,
            back: int = BACK, ahead: int = AHEAD, part: str | None = None) -> DataFrame:
    """Stored features with the changed band replaced.

    With ``part`` (a column of the stored table that depends on the key, as the
    year of the date) only the rows of touched partitions come back, to be written
    with dynamic partition overwrite; without it, the whole table does."""
    band = refresh_band(prices, index, new_keys, back, ahead)
    if part is None:
        return upsert(old_features, band.select(*old_features.columns), KEYS, keep_from_old=())
    band = band.withColumn(part, F.year("trading_date")).select(*old_features.columns)
    return upsert_partitions(old_features, band, [*KEYS, part], [part], keep_from_old=())

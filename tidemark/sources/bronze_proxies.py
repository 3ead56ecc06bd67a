"""Bronze-shaped (all-text, lineage-stamped) feeds derived from the proxy tables.

Two loads per feed exercise the silver step: load 1 carries every key with
vendor null tokens injected at fixed key positions; load 2 re-delivers every key
of a fourth of the days (a property of the key, so the share holds at any size) with
corrected values and a later ``loaded_at``.  Numbers are
rendered from integer cents so the text is identical in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import proxies as P

LOAD1_AT = "2024-01-01 00:00:00"
LOAD2_AT = "2024-01-02 00:00:00"
CORRECTED_DAYS = 4  # load 2 re-delivers days of the month divisible by this


def money_text(cents: str | Column) -> Column:
    """Exact decimal text of integer cents: 12345 -> '123.45'."""
    c = F.col(cents) if isinstance(cents, str) else cents
    return F.concat((c / 100).cast("bigint").cast("string"), F.lit("."),
                    F.lpad((c % 100).cast("string"), 2, "0"))


def _dirty(value: Column, dom: Column, modulus: int, token: str) -> Column:
    return F.when(dom % modulus == 0, F.lit(token)).otherwise(value)


def _lineage(df: DataFrame, src: str, at: str, part: str) -> DataFrame:
    return df.select(
        "*", F.lit(part).cast("date").alias("batch_date"), F.lit(src).alias("src_file"),
        F.lit(1).cast("bigint").alias("src_row"), F.lit(part).alias("part_key"),
        F.lit(at).cast("timestamp").alias("loaded_at"),
    )


def bronze_stock_price(spark: SparkSession, d: str) -> DataFrame:
    p = P.stock_price_eod(spark, d)
    dom = F.dayofmonth("trading_date")

    def load(close_cents: Column, rows: DataFrame) -> DataFrame:
        return rows.select(
            "ticker",
            F.col("trading_date").cast("string").alias("trading_date"),
            _dirty(money_text(F.round(F.col("open") * 100).cast("bigint")), dom, 17, "<NA>").alias("open"),
            _dirty(money_text(F.round(F.col("high") * 100).cast("bigint")), dom, 11, "").alias("high"),
            money_text(F.round(F.col("low") * 100).cast("bigint")).alias("low"),
            _dirty(money_text(close_cents), dom, 7, "NaN").alias("close"),
            _dirty(F.col("volume").cast("string"), dom, 13, "None").alias("volume"),
            money_text(F.round(F.col("value") * 100).cast("bigint")).alias("value"),
            F.lit(None).cast("string").alias("adjusted_close"),
        )

    l1 = _lineage(load(F.col("close_cents"), p), "landing/stock_price_eod/1.parquet", LOAD1_AT, "2024-01-01")
    # vendors re-deliver some days with a corrected close
    l2 = _lineage(load(F.col("close_cents") + 1, p.where(dom % CORRECTED_DAYS == 0)),
                  "landing/stock_price_eod/2.parquet", LOAD2_AT, "2024-01-02")
    return l1.unionByName(l2)


def bronze_corporate_events(spark: SparkSession, d: str) -> DataFrame:
    e = P.corporate_events(spark, d)
    raw = e.select(
        "event_id", "ticker", "event_type",
        F.coalesce(F.col("ex_right_date").cast("string"), F.lit("None")).alias("ex_right_date"),
        F.coalesce(F.col("record_date").cast("string"), F.lit("")).alias("record_date"),
        F.concat(F.lit("event "), F.col("event_id")).alias("event_details"),
    )
    return _lineage(raw, "landing/corporate_events/1.parquet", LOAD1_AT, "2024-01-01")

import datetime as dt
import itertools
import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.plans import incremental as INC
from tidemark.sources import proxies as P

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_banded_refresh_equals_full_recompute(spark):
    prices = P.stock_price_eod(spark, SF)
    index = P.index_price_eod(spark, SF)
    # the last 5 trading days of every ticker arrive late
    w = Window.partitionBy("ticker").orderBy(F.col("trading_date").desc())
    ranked = prices.withColumn("__k", F.row_number().over(w))
    new_keys = ranked.where(F.col("__k") <= 5).select("ticker", "trading_date")
    before = ranked.where(F.col("__k") > 5).drop("__k")
    old = INC.price_features(before, index)

    refreshed = INC.refresh(old, prices, index, new_keys)
    full = INC.price_features(prices, index).select(*refreshed.columns)

    def rows(df):
        return sorted(tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in df.collect())

    assert refreshed.count() == prices.count()
    assert rows(refreshed) == rows(full)
    # the band is much smaller than the history
    band = INC.refresh_band(prices, index, new_keys).count()
    assert band == new_keys.count() + 20 * new_keys.select("ticker").distinct().count()


def test_untouched_tickers_never_reach_a_window(spark):
    prices, index = P.stock_price_eod(spark, SF), P.index_price_eod(spark, SF)
    new_keys = spark.createDataFrame([("Brand#11", dt.date(1998, 1, 5))], "ticker string, trading_date date")
    plan = INC.refresh_band(prices, index, new_keys)._jdf.queryExecution().optimizedPlan().toString().splitlines()

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    windows = [i for i, line in enumerate(plan) if "Window [" in line and "ticker" in line]
    assert windows
    for i in windows:
        below = itertools.takewhile(lambda x, d=depth(plan[i]): depth(x) > d, plan[i + 1 :])
        assert any("Join Inner" in x for x in below)


def test_refresh_of_touched_partitions_only(spark):
    prices, index = P.stock_price_eod(spark, SF), P.index_price_eod(spark, SF)
    full = INC.price_features(prices, index).withColumn("year", F.year("trading_date"))
    newest = prices.agg(F.max("trading_date")).first()[0]
    new_keys = prices.where(F.col("trading_date") == newest).select("ticker", "trading_date")
    touched = INC.refresh(full, prices, index, new_keys, part="year")
    years = [r[0] for r in touched.select("year").distinct().collect()]
    assert len(years) <= 2 and max(years) == newest.year
    assert touched.count() == full.where(F.col("year").isin(years)).count()

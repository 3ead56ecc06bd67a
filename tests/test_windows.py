import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import windows as W
from tidemark.operators.recursive import ema_features


def _series(spark, values, ticker="AAA", start=dt.date(2026, 1, 1)):
    rows = [(ticker, start + dt.timedelta(days=i), float(v) if v is not None else None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ticker string, trading_date date, x double")


def _col(df, c):
    return [r[c] for r in df.orderBy("trading_date").collect()]


def test_lag_return_momentum(spark):
    df = _series(spark, [10, 11, 0, 12, 15])
    w = W.series_window("ticker", "trading_date")
    out = df.select("trading_date", W.lag_n("x", 1, w).alias("l1"), W.simple_return("x", w).alias("r"),
                    W.momentum("x", 2, w).alias("m2"))
    assert _col(out, "l1") == [None, 10, 11, 0, 12]
    r = _col(out, "r")
    assert r[0] is None and r[1] == pytest.approx(0.1) and r[2] == pytest.approx(-1.0)
    assert r[3] is None  # previous close 0 -> no return (guard > 0)
    assert _col(out, "m2")[2] == pytest.approx(-1.0)


def test_rolling_mean_partial_vs_full_window(spark):
    df = _series(spark, [1, 2, 3, 4])
    w = W.series_window("ticker", "trading_date")
    out = df.select("trading_date", W.rolling_mean("x", 3, w).alias("partial"),
                    W.rolling_mean("x", 3, w, min_periods=3).alias("full"))
    assert _col(out, "partial") == [1.0, 1.5, 2.0, 3.0]
    assert _col(out, "full") == [None, None, 2.0, 3.0]


def test_rolling_mean_exact_matches_avg(spark):
    vals = [5, 7, 1, 9, 4, 4, 8]
    rows = [("A", dt.date(2026, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "ticker string, trading_date date, c bigint")
    w = W.series_window("ticker", "trading_date")
    out = W.rolling_mean_exact(df, "c", 3, w, "m").withColumn("ref", W.rolling_mean("c", 3, w))
    got = out.orderBy("trading_date").collect()
    assert [r["m"] for r in got] == [r["ref"] for r in got]


def test_rolling_std_one_value_is_null(spark):
    df = _series(spark, [1, 2, 4])
    w = W.series_window("ticker", "trading_date")
    out = _col(df.select("trading_date", W.rolling_std("x", 3, w).alias("s")), "s")
    assert out[0] is None
    assert out[2] == pytest.approx(pd.Series([1, 2, 4]).std())


def test_rsi_matches_pandas_rule(spark):
    vals = [44, 44.3, 44.1, 43.6, 44.3, 44.8, 45.1, 45.4, 45.8, 46.1, 45.9, 46.3, 46.0, 46.5, 46.2, 46.6, 46.0]
    df = _series(spark, vals)
    w = W.series_window("ticker", "trading_date")
    got = _col(df.select("trading_date", W.rsi("x", w, 14).alias("rsi")), "rsi")
    s = pd.Series(vals)
    delta = s.diff()
    gain = delta.where(delta > 0, 0).rolling(14).mean()
    loss = (-delta.where(delta < 0, 0)).rolling(14).mean()
    ref = 100 - 100 / (1 + gain / loss)
    for g, r in zip(got, ref):
        if isinstance(r, float) and math.isnan(r):
            assert g is None
        else:
            assert g == pytest.approx(r)


def test_rsi_all_gains_is_100(spark):
    df = _series(spark, list(range(1, 17)))
    w = W.series_window("ticker", "trading_date")
    assert _col(df.select("trading_date", W.rsi("x", w, 14).alias("r")), "r")[-1] == 100.0


def test_forward_labels_and_uptrend(spark):
    df = _series(spark, [10, 10, 12, 9, 11])
    w = W.series_window("ticker", "trading_date")
    out = df.select("trading_date", W.forward_return("x", 2, w).alias("f2"),
                    W.uptrend_flag("x", 2, w, 0.05).alias("up"),
                    W.forward_extreme("x", 2, w, "max").alias("mx"), W.forward_extreme("x", 2, w, "min").alias("mn"))
    assert _col(out, "f2")[:3] == [pytest.approx(0.2), pytest.approx(-0.1), pytest.approx(11 / 12 - 1)]
    assert _col(out, "f2")[3:] == [None, None]
    assert _col(out, "up") == [1, 0, 0, None, None]
    assert _col(out, "mx")[0] == pytest.approx(0.2)
    assert _col(out, "mn")[0] == pytest.approx(0.0)
    assert _col(out, "mx")[-1] is None


def test_corr_parity_counts_null_rows(spark):
    # N counts the row whose y is NULL while the sums skip it (reference rule)
    rows = [("A", dt.date(2026, 1, d), x, y) for d, x, y in [(1, 1, 2), (2, 2, 4), (3, 3, None), (4, 4, 9)]]
    df = spark.createDataFrame(rows, "ticker string, trading_date date, x bigint, y bigint")
    w = W.series_window("ticker", "trading_date")
    out = df.select("trading_date", W.rolling_corr_parity("x", "y", w, 10).alias("p"),
                    W.rolling_corr("x", "y", w, 10).alias("c")).orderBy("trading_date").collect()
    assert out[0]["p"] is None
    assert out[1]["p"] == pytest.approx(1.0)
    n, sx, sy, sxx, syy, sxy = 4, 10, 15, 30, 101, 1 * 2 + 2 * 4 + 4 * 9
    ref = (n * sxy - sx * sy) / math.sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))
    assert out[3]["p"] == pytest.approx(ref)
    assert out[3]["c"] == pytest.approx(pd.Series([1, 2, 4]).corr(pd.Series([2, 4, 9])))


def test_flow_momentum_window_over_window(spark):
    df = _series(spark, [1, 2, 3, 4, 5])
    w = W.series_window("ticker", "trading_date")
    out = W.flow_momentum(df, "x", w, 2, out="m", sum_col="s")
    assert _col(out, "s") == [1, 3, 5, 7, 9]
    assert _col(out, "m")[2:] == [pytest.approx(5 / 1 - 1), pytest.approx(7 / 3 - 1), pytest.approx(9 / 5 - 1)]


def test_date_percent_rank_equals_percent_rank(spark):
    rows = [(dt.date(2026, 1, 1 + (i % 7)),) for i in range(40)]
    df = spark.createDataFrame(rows, "d date")
    ours = {r["d"]: r["pct"] for r in W.date_percent_rank(df, "d").collect()}
    from pyspark.sql import Window

    ref = {r["d"]: r["p"] for r in df.select("d", F.percent_rank().over(Window.orderBy("d")).alias("p")).collect()}
    assert ours.keys() == ref.keys()
    for k in ours:
        assert ours[k] == pytest.approx(ref[k])


def test_ema_and_macd_match_pandas(spark):
    vals = [10, 11, 10.5, 12, 13, 12.5, 14, 13.5, 15, 16]
    df = _series(spark, vals)
    out = ema_features(df, "ticker", "trading_date", "x").orderBy("trading_date").toPandas()
    s = pd.Series(vals)
    ref12 = s.ewm(span=12, adjust=False).mean()
    ref26 = s.ewm(span=26, adjust=False).mean()
    assert out["ema_12"].tolist() == pytest.approx(ref12.tolist())
    assert out["macd"].tolist() == pytest.approx((ref12 - ref26).tolist())


def test_exact_mean_skips_nulls(spark):
    rows = [("A", i, v) for i, v in enumerate([100, 200, None, 400, 500, None, None])]
    df = spark.createDataFrame(rows, "ticker string, trading_date int, v long")
    w = W.series_window("ticker", "trading_date")
    out = W.rolling_mean_exact(df, "v", 2, w, "exact").withColumn("plain", W.rolling_mean("v", 2, w)).orderBy("trading_date").collect()
    assert [r["exact"] for r in out] == [r["plain"] for r in out] == [100.0, 150.0, 200.0, 400.0, 450.0, 500.0, None]


def test_correlation_of_fractions(spark):
    rows = [("A", i, x, y) for i, (x, y) in enumerate([(0.1, 0.3), (0.2, 0.5), (0.4, 0.7), (0.3, 0.8)])]
    df = spark.createDataFrame(rows, "ticker string, trading_date int, x double, y double")
    dec = df.select("ticker", "trading_date", *[F.col(c).cast("decimal(38,4)").alias(c) for c in ("x", "y")])
    w = W.series_window("ticker", "trading_date")
    want = np.corrcoef([r[2] for r in rows], [r[3] for r in rows])[0, 1]
    for frame in (df, dec):
        for mode in ("pairs", "parity"):
            got = W.with_rolling_corr(frame, "x", "y", w, 10, "c", mode=mode).orderBy("trading_date").collect()
            assert got[-1]["c"] == pytest.approx(want) and got[0]["c"] is None


def test_marts_have_their_declared_types(spark):
    from tidemark.operators.quality import check_schema
    from tidemark.plans import marts

    rows = [("A", dt.date(2026, 1, 1) + dt.timedelta(days=i), 10 + i / 7) for i in range(40)]
    prices = spark.createDataFrame(rows, "ticker string, trading_date date, p double").select(
        "ticker", "trading_date", F.col("p").cast("decimal(38,4)").alias("adjusted_close"))
    index = prices.select(F.lit("VNINDEX").alias("index_name"), "trading_date", F.col("adjusted_close").alias("close"))
    mart = marts.momentum_mart(prices, index, labels=True)
    out = marts.typed(mart)
    assert check_schema(out, marts.declared(out.columns)) == [] and dict(out.dtypes)["volatility_30d"] == "decimal(18,6)"
    assert 0 < mart.orderBy(F.col("trading_date").desc()).first()["volatility_30d"] < 0.01

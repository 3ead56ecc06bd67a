import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.casts import num, typed
from tidemark.operators.asof import asof_backward
from tidemark.operators.conform import conform, require_columns, standardise
from tidemark.operators.dedupe import latest_loaded
from tidemark.operators.silver import to_silver, with_audit
from tidemark.operators.upsert import upsert, upsert_partitions
from tidemark.schemas import FEEDS, feed


def test_all_fifteen_feeds_declared():
    assert len(FEEDS) == 15
    for f in FEEDS.values():
        assert set(f.keys) <= set(f.bronze_columns)


def test_guarded_numeric_cast(spark):
    df = spark.createDataFrame([("1.5",), ("NaN",), ("",), ("None",), ("<NA>",), ("abc",), (None,)], "v string")
    got = [r[0] for r in df.select(num("v").cast("double")).collect()]
    assert got == [1.5, None, None, None, None, None, None]


def test_truncating_text_cast(spark):
    df = spark.createDataFrame([("x" * 300,)], "v string")
    assert len(df.select(typed("v", "S256")).first()[0]) == 256


def test_latest_load_wins_with_stable_tie_break(spark):
    rows = [("A", "2026-01-01", "1", "f1", 1, "2026-01-01 00:00:00"),
            ("A", "2026-01-01", "2", "f2", 1, "2026-01-02 00:00:00"),
            ("B", "2026-01-01", "3", "f1", 1, "2026-01-01 00:00:00"),
            ("B", "2026-01-01", "4", "f2", 1, "2026-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "ticker string, trading_date string, close string, src_file string, "
                                     "src_row long, loaded_at string").withColumn("loaded_at", F.col("loaded_at")
                                                                                  .cast("timestamp"))
    got = {r["ticker"]: r["close"] for r in latest_loaded(df, ["ticker", "trading_date"]).collect()}
    assert got == {"A": "2", "B": "4"}


def test_to_silver_casts_and_falls_back(spark):
    cols = feed("stock_price_eod").bronze_columns
    rec = dict(ticker="AAA", trading_date="2026-06-18", open="NaN", high="31.8", low="31.35", close="31.45",
               volume="16629400", value=None, adjusted_close=None)
    df = spark.createDataFrame([tuple(rec[c] for c in cols)], ", ".join(f"{c} string" for c in cols))
    df = df.select("*", F.lit("f").alias("src_file"), F.lit(1).alias("src_row"),
                   F.current_timestamp().alias("loaded_at"))
    out = to_silver(df, "stock_price_eod", job="t", batch_date="2026-06-18", user="u", at="2026-06-18 10:00:00")
    r = out.first()
    assert r["open"] is None
    assert float(r["adjusted_close"]) == 31.45
    assert r["trading_date"] == dt.date(2026, 6, 18)
    assert r["created_by_job"] == "t" and r["batch_date"] == dt.date(2026, 6, 18)
    assert str(out.schema["close"].dataType) == "DecimalType(38,4)"


def test_upsert_keeps_created_and_is_idempotent(spark):
    old = with_audit(spark.createDataFrame([("A", 1.0), ("B", 2.0)], "k string, v double"), "day1", "2026-01-01",
                     user="u", at="2026-01-01 00:00:00")
    new = with_audit(spark.createDataFrame([("B", 5.0), ("C", 3.0), (None, 9.0)], "k string, v double"), "day2",
                     "2026-01-02", user="u", at="2026-01-02 00:00:00")
    merged = upsert(old, new, ["k"])
    got = {r["k"]: r for r in merged.collect()}
    assert set(got) == {"A", "B", "C"}  # the NULL key never merges
    assert got["B"]["v"] == 5.0 and got["B"]["created_by_job"] == "day1" and got["B"]["updated_by_job"] == "day2"
    assert got["C"]["created_by_job"] == "day2"
    again = upsert(merged, new, ["k"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, merged.collect()))


def test_upsert_partitions_touches_only_batch_partitions(spark):
    old = spark.createDataFrame([("A", "d1", 1), ("A", "d2", 2)], "k string, d string, v int")
    new = spark.createDataFrame([("A", "d2", 20)], "k string, d string, v int")
    out = upsert_partitions(old, new, ["k", "d"], ["d"], keep_from_old=())
    assert [tuple(r) for r in out.collect()] == [("A", "d2", 20)]


def test_conform_fixture(spark):
    df = spark.createDataFrame([("AAA", 1.0, "x")], "symbol string, close double, extra_col string")
    out = conform(df, ["symbol", "close", "volume"], upper=True)
    assert out.columns == ["SYMBOL", "CLOSE", "VOLUME"]
    assert out.first()["VOLUME"] is None
    std = standardise(spark.createDataFrame([("NaN", "ok")], "a string, b string"), ["a", "b"])
    assert tuple(std.first()) == (None, "ok")
    with pytest.raises(ValueError):
        require_columns(df, ["SYMBOL", "missing"])
    require_columns(df, ["SYMBOL", "CLOSE"])


def test_asof_backward_includes_equal_dates_and_null_payloads(spark):
    left = spark.createDataFrame([("A", dt.date(2026, 1, d)) for d in (1, 5, 10, 20)], "t string, d date")
    right = spark.createDataFrame([("A", dt.date(2026, 1, 5), 1.0), ("A", dt.date(2026, 1, 15), None)],
                                  "t string, rd date, v double")
    out = asof_backward(left, right, ["t"], "d", "rd", ["rd", "v"]).orderBy("d").collect()
    assert [r["rd"] for r in out] == [None, dt.date(2026, 1, 5), dt.date(2026, 1, 5), dt.date(2026, 1, 15)]
    assert out[1]["v"] == 1.0 and out[3]["v"] is None


def test_macro_pivots_accept_both_spellings(spark):
    from tidemark.plans import marts

    rates = spark.createDataFrame([("us_fed_funds_rate", dt.date(2026, 1, 2), 4.0), ("^TNX", dt.date(2026, 1, 2), 4.5)],
                                  "rate_type string, date date, rate_value double")
    r = marts.rates_pivot(rates).first()
    assert (r["fed_rate"], r["treasury_10y"], r["treasury_5y"]) == (4.0, 4.5, None)
    fx = spark.createDataFrame([("USD/VND", dt.date(2026, 1, d), 25000.0 + d) for d in range(1, 4)],
                               "pair string, date date, exchange_rate double")
    got = marts.fx_volatility(fx).orderBy("date").collect()
    assert [g["usd_vnd_rate"] for g in got] == [25001.0, 25002.0, 25003.0]
    assert got[0]["exchange_rate_volatility_30d"] is None and got[2]["exchange_rate_volatility_30d"] is not None
    macro = spark.createDataFrame([("vn_cpi_inflation", dt.date(2026, 1, 1), 3.1)],
                                  "indicator_name string, report_date date, value double")
    assert marts.macro_pivot(macro).first()["cpi_value"] == 3.1

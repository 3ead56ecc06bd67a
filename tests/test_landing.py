import datetime as dt
import io
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.functions.dates import available_on, next_weekday, period_to_date
from tidemark.operators import normalise as N
from tidemark.operators.gaps import gap_report, pending, quarterly_gaps
from tidemark.sources import text as X


def test_foreign_flow_fixture(spark):
    raw = spark.createDataFrame([("FPT", "2026-06-18T00:00:00Z", 100, 80, 5000, 3000)],
                                "symbol string, date string, buyForeignQuantity long, sellForeignQuantity long, "
                                "buyForeignValue long, sellForeignValue long")
    r = N.norm_foreign_flow(raw).first()
    assert r["trading_date"] == "2026-06-18" and r["net_val"] == 2000 and r["buy_vol"] == 100


def test_prop_flow_drops_zero_net(spark):
    raw = spark.createDataFrame([("FPT", "2026-06-18", 50000000), ("FPT", "2026-06-19", 0)],
                                "symbol string, date string, propTradingNetValue long")
    out = N.norm_prop_flow(raw).collect()
    assert len(out) == 1 and out[0]["net_val"] == "50000000" and out[0]["buy_vol"] == "0"


def test_news_ticker_filled_only_when_all_null(spark):
    raw = spark.createDataFrame([("1", None, "AAA"), ("2", None, "AAA"), ("3", "X", "BBB"), ("4", None, "BBB")],
                                "id string, ticker string, symbol string")
    got = {r["article_id"]: r["ticker"] for r in N.norm_news(raw).collect()}
    assert got == {"1": "AAA", "2": "AAA", "3": "X", "4": None}


def test_events_and_reports_fallbacks(spark):
    ev = spark.createDataFrame([("123", None, "DIVIDEND", "2026-07-01", "2026-07-02", "VCB")],
                               "id string, ticker string, category string, exright_date string, record_date string, "
                               "symbol string")
    r = N.norm_events(ev).first()
    assert (r["event_id"], r["ticker"], r["event_type"], r["ex_right_date"]) == ("123", "VCB", "DIVIDEND", "2026-07-01")
    rep = spark.createDataFrame([(101, "", "SSI", "2026-01-01", "t", "d", "f.pdf", "TCB")],
                                "reportID long, symbol string, sourceName string, date string, title string, "
                                "description string, fileName string, req string")
    assert N.norm_reports(rep, "req").first()["ticker"] == "TCB"


def test_period_text_to_date(spark):
    df = spark.createDataFrame([("2024",), ("2024M06",), ("2024M6",), ("2024Q2",), ("junk",)], "p string")
    got = [r[0] for r in df.select(period_to_date("p")).collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 6, 1), dt.date(2024, 6, 1), dt.date(2024, 4, 1), None]


def test_latest_non_null_macro(spark):
    raw = spark.createDataFrame([("cpi", "2024", None, None), ("cpi", "2023", 3.5, "%"), ("cpi", "2022", 2.0, "%")],
                                "indicator_name string, date string, value double, unit string")
    r = N.latest_non_null_macro(raw).first()
    assert (r["report_date"], r["value"], r["unit"]) == ("2023-01-01", "3.5", "%")


def _items(spark, labels_values, ticker="AAA", period="2026-Q1"):
    return spark.createDataFrame([(ticker, k, period, float(v)) for k, v in labels_values],
                                 "ticker string, item_en string, period_label string, value double")


def test_income_statement_pivot_fixture(spark):
    labels = list(N.INCOME_MAPS[0])
    items = _items(spark, list(zip(labels, [100, 40, 60, 10, 50, 5, 3, 35])))
    cols = list(dict.fromkeys(N.INCOME_MAPS[0].values()))
    out = N.statement_wide(items, N.label_map_frame(spark, N.INCOME_MAPS), cols, latest_only=True).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["period"], r["year"], r["revenue"], r["cogs"], r["net_profit_after_tax"]) == ("Q1", "2026", "100.0",
                                                                                             "40.0", "35.0")


def test_statement_without_known_labels_gives_no_row(spark):
    items = _items(spark, [("Unknown", 1)])
    assert N.statement_wide(items, N.label_map_frame(spark, N.INCOME_MAPS), ["revenue"]).count() == 0


def test_balance_sheet_bank_map_fallback(spark):
    items = _items(spark, [(k, i + 1) for i, k in enumerate(N.BALANCE_MAPS[1])])
    cols = list(dict.fromkeys(v for m in N.BALANCE_MAPS for v in m.values()))
    r = N.statement_wide(items, N.label_map_frame(spark, N.BALANCE_MAPS), cols).first()
    assert r["total_assets"] == "1.0" and r["current_assets"] is None and r["equity"] == "4.0"


def test_report_availability_and_next_weekday(spark):
    df = spark.createDataFrame([(2024, "Q1"), (2024, "Q4"), (2024, "N")], "year int, period string")
    got = [r[0] for r in df.select(available_on("year", "period")).collect()]
    assert got == [dt.date(2024, 5, 1), dt.date(2025, 2, 1), dt.date(2025, 4, 1)]
    days = spark.createDataFrame([(dt.date(2026, 6, 19),), (dt.date(2026, 6, 20),), (dt.date(2026, 6, 16),)], "d date")
    assert [r[0] for r in days.select(next_weekday("d")).collect()] == [
        dt.date(2026, 6, 22), dt.date(2026, 6, 22), dt.date(2026, 6, 17)]


def test_text_cleaners(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.txt")
    with open(p, "wb") as fh:
        fh.write(b"test\x00\r\nt\x00e\x00s\x00t\x00_\n")
    lines = X.strip_nul(X.read_lines(spark, p)).orderBy("line_no")
    assert [r["value"] for r in lines.collect()] == ["test\r", "test_"]
    p16 = os.path.join(tmp_dir, "b.txt")
    with open(p16, "wb") as fh:
        fh.write("te\x00st\nx\n".encode("utf-16"))
    got = [r["value"] for r in X.strip_nul(X.read_lines(spark, p16, "UTF-16")).orderBy("line_no").collect()]
    assert got[:2] == ["test", "x"]
    bad = os.path.join(tmp_dir, "c.txt")
    with open(bad, "w") as fh:
        fh.write("test\ninvalid formula 1\ntest2\nsome invalid formula\n")
    kept = [r["value"] for r in X.drop_lines(X.read_lines(spark, bad)).orderBy("line_no").collect()]
    assert kept == ["test", "test2"]


def test_expand_archives_skips_unsafe_members(spark, tmp_dir):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        zf.writestr("data/a.csv", "x,y\n1,2\n")
        zf.writestr("../evil.txt", "no")
    with open(os.path.join(tmp_dir, "pack.zip"), "wb") as fh:
        fh.write(buf.getvalue())
    out = X.expand_archives(spark, tmp_dir).collect()
    assert [r["member"] for r in out] == ["data/a.csv"]
    with pytest.raises(ValueError):
        X.preprocess(spark, tmp_dir, "bogus")


def test_stage_key_new_and_legacy(spark):
    df = spark.createDataFrame([("s3://b/raw/RAW_X/batch_date=2026-01-02/1767312000/RAW_X.parquet", None),
                                ("s3://b/raw/RAW_Y/batch_date=2026-01-03/RAW_Y.parquet", "2026-01-03 10:00:00")],
                               "file string, mtime string")
    rows = X.stage_key(df, "file", "mtime").collect()
    assert (rows[0]["stage_table"], rows[0]["stage_ts"]) == ("RAW_X", 1767312000)
    assert rows[1]["stage_table"] == "RAW_Y" and rows[1]["stage_ts"] is not None


def test_gaps_and_pending(spark):
    rep = spark.createDataFrame([("A", 2024, "Q1"), ("A", 2024, "Q4"), ("B", 2024, "Q2")],
                                "ticker string, year int, period string")
    gaps = quarterly_gaps(rep, "income").select("symbol", "year", "period").orderBy("period").collect()
    assert [tuple(r) for r in gaps] == [("A", 2024, "Q2"), ("A", 2024, "Q3")]
    g1 = quarterly_gaps(rep, "income").withColumn("run_id", F.lit(1))
    g2 = quarterly_gaps(rep, "income").withColumn("run_id", F.lit(2))
    assert {r["run_id"] for r in gap_report(g1, g2).collect()} == {2}
    units = spark.createDataFrame([("A",), ("B",)], "k string")
    assert [r[0] for r in pending(units, spark.createDataFrame([("A",)], "k string"), ["k"]).collect()] == ["B"]

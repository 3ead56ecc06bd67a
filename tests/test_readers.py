import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import keys_on, variant_col, variant_field
from tidemark.operators import load as L
from tidemark.operators import normalise as N
from tidemark.schemas import feed
from tidemark.sources import readers as R


def test_read_bronze_formats(spark, tmp_dir):
    schema = feed("interest_rates").bronze_schema()
    pq = os.path.join(tmp_dir, "pq")
    spark.createDataFrame([("^IRX", "2026-01-02", "4.1")], schema).write.parquet(pq)
    assert R.read_bronze(spark, pq, "PARQUET", schema).count() == 1
    js = os.path.join(tmp_dir, "a.json")
    with open(js, "w") as fh:
        fh.write(json.dumps({"RATE_TYPE": "^TNX", "Date": "2026-01-02", "rate_value": "4.2"}) + "\n")
    r = R.read_bronze(spark, js, "json", schema).first()
    assert (r["rate_type"], r["rate_value"]) == ("^TNX", "4.2")  # field names match case-insensitively
    cs = os.path.join(tmp_dir, "a.csv")
    with open(cs, "w") as fh:
        fh.write("rate_type,date,rate_value\n^FVX,2026-01-02,3.9\n")
    assert R.read_bronze(spark, cs, "csv", schema).first()["rate_value"] == "3.9"
    with pytest.raises(ValueError):
        R.read_bronze(spark, cs, "xml", schema)
    with pytest.raises(ValueError):
        R.read_bronze(spark, "http://example/x", "csv", schema)


def test_csv_and_mixed_folders(spark, tmp_dir):
    assert R.read_csv_folder(spark, os.path.join(tmp_dir, "none")) is None
    folder = os.path.join(tmp_dir, "mixed")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as fh:
        fh.write("ticker,close\nAAA,1.5\nBBB,2\n")
    with open(os.path.join(folder, ".hidden.csv"), "w") as fh:
        fh.write("ticker,close\nZZZ,9\n")
    with open(os.path.join(folder, "notes.txt"), "w") as fh:
        fh.write("ignore me")
    import pyarrow as pa
    import pyarrow.parquet as papq

    papq.write_table(pa.table({"ticker": ["CCC"], "close": [3.0], "volume": [7]}), os.path.join(folder, "b.parquet"))
    out = R.read_mixed_folder(spark, folder)
    got = {r["ticker"]: r for r in out.collect()}
    assert set(got) == {"AAA", "BBB", "CCC"}
    assert got["CCC"]["volume"] == "7" and got["AAA"]["volume"] is None
    assert dict(out.dtypes)["close"] == "string"


def test_training_set_and_slices(spark, tmp_dir):
    with pytest.raises(Exception):
        R.read_training_set(spark, os.path.join(tmp_dir, "missing"))
    rows = [("A", dt.date(2026, 1, 1) + dt.timedelta(days=i)) for i in range(200)]
    df = spark.createDataFrame(rows, "ticker string, trading_date date")
    assert R.latest_slice(df, "trading_date").count() == 1
    assert R.lookback_slice(df, "trading_date", days=90).count() == 90
    assert R.lookback_slice(df, "trading_date", anchor="2026-01-10", days=5).count() == 5
    assert R.months_back(df, "trading_date", None).count() == 200
    assert R.months_back(df, "trading_date", 1, as_of="2026-07-19").agg(F.min("trading_date")).first()[0] == \
        dt.date(2026, 6, 19)
    assert [r[0] for r in keys_on(df, "2026-01-03").collect()] == ["A"]


def test_price_and_index_mappings(spark):
    raw = spark.createDataFrame([("FPT", "2026-06-18T00:00:00", 31.75, 31.8, 31.35, 31.45, 16629400)],
                                "symbol string, time string, open double, high double, low double, close double, "
                                "volume long")
    r = N.norm_stock_price(raw).first()
    assert (r["ticker"], r["trading_date"], r["close"], r["adjusted_close"]) == ("FPT", "2026-06-18", "31.45", None)
    idx = raw.withColumn("symbol", F.lit("VNINDEX")).unionByName(raw.withColumn("symbol", F.lit("OTHER")))
    assert [r["index_name"] for r in N.norm_index_price(idx).collect()] == ["VNINDEX"]


def test_profile_mapping_keeps_available_columns(spark):
    raw = spark.createDataFrame([("FPT", "FPT Corp", "Tech", "HOSE", "about")],
                                "symbol string, organ_name string, sector string, com_group_code string, "
                                "company_profile string")
    out = N.norm_profile(raw)
    assert out.columns == ["ticker", "company_name", "industry", "exchange", "description"]


def test_quote_mapping(spark):
    raw = spark.createDataFrame([("BZ=F", dt.datetime(2026, 6, 18), 78.1, 78.5)],
                                "symbol string, Date timestamp, Open double, Close double")
    mapping = spark.createDataFrame([("BZ=F", "Brent Crude")], "code string, commodity_name string")
    r = N.norm_quotes(raw, mapping, "commodity_name", "price").first()
    assert (r["commodity_name"], r["date"], r["price"]) == ("Brent Crude", "2026-06-18", "78.5")


def test_variant_json(spark):
    df = spark.createDataFrame([('{"k": 69}',), ("not json",)], "props string")
    assert [r[0] for r in df.select(variant_field(variant_col("props"), "$.k", "int")).collect()] == [69, None]


def test_landing_write_and_export(spark, tmp_dir):
    df = spark.createDataFrame([("A", "1")], "ticker string, close string")
    root = os.path.join(tmp_dir, "landing")
    assert L.write_landing(df, root, "RAW_X", "2026-01-01") == 1
    assert L.write_landing(df, root, "RAW_X", "2026-01-01") == 1
    assert L.write_landing(df.limit(0), root, "RAW_X", "2026-01-02") == 0
    assert spark.read.parquet(os.path.join(root, "RAW_X")).count() == 1
    assert L.export_training(df, os.path.join(tmp_dir, "export")) == 1
    with pytest.raises(ValueError):
        L.export_training(df.limit(0), os.path.join(tmp_dir, "export0"))


def test_headers_in_any_order(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "headers")
    os.makedirs(folder)
    for name, body in (("a.csv", "x,y\n1,2\n"), ("b.csv", "y,x,z\n4,3,5\n"), ("c.csv", "x,y\n6\n7,8,9\n")):
        with open(os.path.join(folder, name), "w") as fh:
            fh.write(body)
    mixed = sorted(map(tuple, R.read_mixed_folder(spark, folder).select("x", "y", "z").collect()), key=str)
    assert mixed == [("1", "2", None), ("3", "4", "5"), ("6", None, None)]
    assert R.read_csv_folder(spark, folder).where("x = '3' and y = '4' and z = '5'").count() == 1


def test_archives_of_any_suffix_and_text_of_either_byte_order(spark, tmp_dir):
    import gzip
    import zipfile

    from tidemark.sources import text as X

    folder, lines = os.path.join(tmp_dir, "arc"), os.path.join(tmp_dir, "utf16")
    os.makedirs(folder)
    os.makedirs(lines)
    with gzip.open(os.path.join(folder, "x.csv.gz"), "wb") as fh:
        fh.write(b"one")
    for name in ("y.zip", "Z.ZIP"):
        with zipfile.ZipFile(os.path.join(folder, name), "w") as z:
            z.writestr(name[0] + ".csv", "two")
    with open(os.path.join(folder, "other.txt"), "w") as fh:
        fh.write("no archive")
    got = {(r["member"], bytes(r["content"])) for r in X.expand_archives(spark, folder).collect()}
    assert got == {("x.csv", b"one"), ("y.csv", b"two"), ("Z.csv", b"two")}
    body = "a\n\n  b\r\nc\n"
    for name, order, mark in (("le.txt", "utf-16-le", b"\xff\xfe"), ("be.txt", "utf-16-be", b"\xfe\xff")):
        with open(os.path.join(lines, name), "wb") as fh:
            fh.write(mark + body.encode(order))
    rows = X.read_lines(spark, lines, "UTF-16").collect()
    for name in ("le.txt", "be.txt"):
        own = [r["value"] for r in sorted((r for r in rows if r["file"].endswith(name)), key=lambda r: r["line_no"])]
        assert own == ["a", "", "  b\r", "c"]

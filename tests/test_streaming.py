import os

import pytest

from pyspark.sql import functions as F

from tidemark.schemas import feed
from tidemark.streaming.landing import refresh_silver, start_landing_stream


def _land(spark, root, batch_date, rows):
    cols = feed("stock_price_eod").bronze_columns
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    df.write.mode("append").parquet(os.path.join(root, f"batch_date={batch_date}"))


def _row(t, d, close):
    return (t, d, "1", "2", "0.5", close, "100", None, None)


def test_landing_stream_loads_each_file_once(spark, tmp_dir):
    landing, bronze, silver, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "bronze", "silver", "ckpt"))
    _land(spark, landing, "2026-01-01", [_row("A", "2026-01-01", "10"), _row("B", "2026-01-01", "NaN")])
    q = start_landing_stream(spark, landing, bronze, ckpt, "stock_price_eod", silver_path=silver)
    q.awaitTermination()
    assert spark.read.parquet(bronze).count() == 2
    s = spark.read.parquet(silver)
    got = {r["ticker"]: r["close"] for r in s.collect()}
    assert float(got["A"]) == 10.0 and got["B"] is None

    # a correction arrives later for A: the newer load wins, created_* is kept
    _land(spark, landing, "2026-01-02", [_row("A", "2026-01-01", "11")])
    q = start_landing_stream(spark, landing, bronze, ckpt, "stock_price_eod", silver_path=silver)
    q.awaitTermination()
    s = spark.read.parquet(silver)
    assert s.count() == 2
    assert float(s.where(F.col("ticker") == "A").first()["close"]) == 11.0

    # nothing new: the checkpoint is the cursor, no file is loaded twice
    before = spark.read.parquet(bronze).count()
    q = start_landing_stream(spark, landing, bronze, ckpt, "stock_price_eod", silver_path=silver)
    q.awaitTermination()
    assert spark.read.parquet(bronze).count() == before


def _load(spark, root, **options):
    a = [os.path.join(root, x) for x in ("landing", "bronze", "ckpt")]
    start_landing_stream(spark, *a, "stock_price_eod", silver_path=os.path.join(root, "silver"), **options).awaitTermination()
    return spark.read.parquet(os.path.join(root, "bronze")), spark.read.parquet(os.path.join(root, "silver"))


def test_more_files_than_a_trigger_and_a_late_file(spark, tmp_dir):
    for i in range(7):
        _land(spark, os.path.join(tmp_dir, "landing"), "2026-01-01", [_row(f"T{i}", "2026-01-01", str(i))])
    bronze, silver = _load(spark, tmp_dir, max_files=3)
    assert bronze.count() == silver.count() == 7
    _land(spark, os.path.join(tmp_dir, "landing"), "2026-01-01", [_row("LATE", "2026-01-01", "9")])
    bronze, silver = _load(spark, tmp_dir, max_files=3)
    assert bronze.count() == silver.count() == 8


def test_later_batches_leave_other_months_alone(spark, tmp_dir):
    landing, silver = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "silver")
    _land(spark, landing, "2026-01-01", [_row("A", "2026-01-01", "10")])
    _load(spark, tmp_dir)
    # another job corrects January
    fixed = spark.read.parquet(silver).withColumn("close", F.lit("99").cast("decimal(38,4)"))
    fixed = spark.createDataFrame(fixed.collect(), fixed.schema)
    fixed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(silver)
    _land(spark, landing, "2026-02-01", [_row("A", "2026-02-01", "12")])
    _, s = _load(spark, tmp_dir)
    assert sorted((str(r["trading_date"]), float(r["close"])) for r in s.collect()) == [("2026-01-01", 99.0), ("2026-02-01", 12.0)]


def test_an_unreadable_silver_file_is_an_error(spark, tmp_dir):
    landing, silver = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "silver")
    _land(spark, landing, "2026-01-01", [_row("A", "2026-01-01", "10"), _row("B", "2026-01-01", "11")])
    _load(spark, tmp_dir)
    before = sorted(os.listdir(os.path.join(silver, "part=2026-01")))
    with open(os.path.join(silver, "part=2026-01", "part-broken.parquet"), "w") as f:
        f.write("no parquet")
    _land(spark, landing, "2026-01-02", [_row("C", "2026-01-02", "12")])
    with pytest.raises(Exception):
        _load(spark, tmp_dir)
    assert set(before) <= set(os.listdir(os.path.join(silver, "part=2026-01")))


def test_staged_result_is_applied_again_after_a_failure(spark, tmp_dir):
    silver = os.path.join(tmp_dir, "silver")
    schema = ", ".join(f"{c} string" for c in feed("company_profile").bronze_columns)
    lineage = [F.lit("2026-01-01").cast("date").alias("batch_date"), F.lit("f").alias("src_file"), F.lit(1).alias("src_row"),
               F.lit("p").alias("part_key"), F.current_timestamp().alias("loaded_at")]
    rows = lambda xs: spark.createDataFrame(xs, schema).select("*", *lineage)
    cols = len(feed("company_profile").bronze_columns)
    make = lambda t, n: (t, n) + (None,) * (cols - 2)
    refresh_silver(rows([make("A", "one"), make("B", "two"), make(None, "none")]), silver, "company_profile", 0)
    assert spark.read.parquet(silver).count() == 2
    # the merge of batch 1 was staged, then the swap failed with part of silver gone
    staged = f"{silver}.staging/batch=1"
    spark.read.parquet(silver).write.partitionBy("part").parquet(staged)
    gone = next(x for x in os.listdir(silver) if x.startswith("part="))
    os.rename(os.path.join(silver, gone), os.path.join(tmp_dir, "gone"))
    refresh_silver(rows([make("A", "one")]), silver, "company_profile", 1)
    assert sorted(r["ticker"] for r in spark.read.parquet(silver).collect()) == ["A", "B"]
    assert not os.path.exists(staged)
    refresh_silver(rows([]), silver, "company_profile", 2)
    assert spark.read.parquet(silver).count() == 2

"""CSV folders, loads that break off, dead letters, gap intervals, the EMA scan."""

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import gaps as G
from tidemark.operators import load as L
from tidemark.operators.recursive import ema_features
from tidemark.sources import readers as R
from tidemark.streaming import landing as S


def _files(folder, **bodies):
    os.makedirs(folder, exist_ok=True)
    for name, body in bodies.items():
        with open(os.path.join(folder, name.replace("__", ".")), "w", newline="") as fh:
            fh.write(body)


def test_quoted_separators_and_line_ends(spark, tmp_dir):
    _files(tmp_dir, a__csv='x,y,z\n"a,b,c,d",q\n4,5,6,7\n\n1,"two\r\nlines ""quoted""",""\n,,last\n', b__csv="﻿z,x\n9,8\n", _hidden__csv="x\n0\n", c__txt="x\n0\n", e__csv="")
    want = sorted([("a,b,c,d", "q", None), ("1", 'two\r\nlines "quoted"', ""), (None, None, "last"), ("8", None, "9")], key=str)
    for out in (R.read_csv_folder(spark, tmp_dir), R.read_mixed_folder(spark, tmp_dir)):
        assert out.columns == ["x", "y", "z"]
        assert sorted(map(tuple, out.collect()), key=str) == want
    with pytest.raises(Exception, match="more fields than the header"):
        R.read_csv_folder(spark, tmp_dir, malformed="fail").collect()
    with pytest.raises(ValueError, match="malformed"):
        R.read_csv_folder(spark, tmp_dir, malformed="keep")
    typed = R.read_csv_folder(spark, tmp_dir, spark.createDataFrame([], "y string, x int, w string").schema)
    assert sorted(map(tuple, typed.where("x is not null").collect()), key=str) == [("two\r\nlines \"quoted\"", 1, None), (None, 8, None)]


def test_many_small_files_share_tasks(spark, tmp_dir):
    for i in range(30):
        _files(tmp_dir, **{f"f{i}__csv": f"k,v{i % 2}\n{i},a\n"})
    out = R.read_csv_folder(spark, tmp_dir)
    assert out.count() == 30 and sorted(out.columns) == ["k", "v0", "v1"] and out.rdd.getNumPartitions() == 1


def test_an_empty_delivery_removes_what_was_there(spark, tmp_dir):
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    for day in ("2026-01-01", "2026-01-02"):
        assert L.load_bronze(df, tmp_dir, day, src_file="f") == 3
    assert L.load_bronze(df.limit(0), tmp_dir, "2026-01-01", src_file="f") == 0
    assert {str(r["part_key"]) for r in spark.read.parquet(tmp_dir).collect()} == {"2026-01-02"}
    preds = spark.createDataFrame([("A", 0.1)], "ticker string, predicted_return double")
    table = f"{tmp_dir}/forecast"
    for rows in (preds, preds.limit(0)):
        L.publish_forecast(L.forecast_rows(rows, "2026-01-05", "v1"), table, "2026-01-05")
    L.publish_forecast(L.forecast_rows(preds, "2026-01-06", "v1"), table, "2026-01-06")
    assert [str(r["trading_date"]) for r in spark.read.parquet(table).collect()] == ["2026-01-06"]


def _batch(spark, files, date="2026-01-01"):
    rows = [(f"T{i}", f, date) for f in files for i in range(5)]
    return spark.createDataFrame(rows, "ticker string, src_file string, batch_date string").withColumn("batch_date", F.col("batch_date").cast("date"))


def test_a_load_that_breaks_off_ends_with_every_row_once(spark, tmp_dir, monkeypatch):
    bronze = f"{tmp_dir}/bronze"
    load = S.load_batch_fn(bronze)
    load(_batch(spark, ["a", "b"]), 0)

    class Broken(Exception):
        pass

    def breaks(*_):
        raise Broken

    # the data is written, the register is not
    real = S.register_path
    monkeypatch.setattr(S, "register_path", lambda p: real(p) if not breaking[0] or not written() else breaks())
    breaking = [True]
    written = lambda: len([p for p in os.listdir(f"{bronze}/part_key=2026-01-01") if p.startswith("load_id")]) > 1
    with pytest.raises(Broken):
        load(_batch(spark, ["b", "c", "d"]), 1)
    left = next(p for p in os.listdir(f"{bronze}/part_key=2026-01-01") if p.startswith("load_id") and p.split("=")[1] not in
                {r["load_id"] for r in spark.read.parquet(real(bronze)).collect()})
    parts = [f for f in os.listdir(f"{bronze}/part_key=2026-01-01/{left}") if f.endswith(".parquet")]
    os.remove(f"{bronze}/part_key=2026-01-01/{left}/{parts[0]}")  # it broke off between part files
    breaking[0] = False
    assert {r["src_file"] for r in S.committed(spark, bronze).collect()} == {"a", "b"}
    for _ in range(2):
        load(_batch(spark, ["b", "c", "d"]), 1)
    rows = spark.read.parquet(bronze)
    assert rows.count() == 20 == S.committed(spark, bronze).count()
    assert {(r["src_file"], r["n"]) for r in rows.groupBy("src_file").agg(F.countDistinct("ticker").alias("n")).collect()} == {(f, 5) for f in "abcd"}
    assert {(r["src_file"], r["rows"]) for r in S.register(spark, bronze).collect()} == {(f, 5) for f in "abcd"}


def test_dead_letters_keep_the_reason_and_a_replay_replaces_them(spark, tmp_dir):
    bronze = f"{tmp_dir}/bronze"
    load = S.load_batch_fn(bronze)
    batch = _batch(spark, ["a"]).unionByName(_batch(spark, [None])).unionByName(_batch(spark, ["c"], None))
    for _ in range(2):
        load(batch, 7)
    aside = spark.read.parquet(S.dead_letter_path(bronze))
    assert {(r["reason"], r["n"]) for r in aside.groupBy("reason").agg(F.count("*").alias("n")).collect()} == {("no source file", 5), ("no batch date", 5)}
    assert spark.read.parquet(bronze).count() == 5
    load(_batch(spark, ["c"]), 8)
    assert spark.read.parquet(bronze).count() == 10


def test_gap_intervals(spark):
    q = lambda *rows: spark.createDataFrame(list(rows), "ticker string, year int, period string")
    rep = q(("A", 2024, "Q1"), ("A", 2024, "Q4"), ("A", 2024, "Q4"), ("B", 2024, "Q2"), ("X", 2023, "Q1"))
    at = lambda y, n: y * 4 + n - 1
    shown = lambda df: sorted(tuple(r)[1:5] for r in df.collect())
    assert shown(G.gap_intervals(rep, "t")) == [("A", at(2024, 2), at(2024, 3), 2)]
    universe = spark.createDataFrame([("A",), ("B",), ("C",), ("C",)], "ticker string")
    assert shown(G.gap_intervals(rep, "t", universe=universe)) == [
        ("A", at(2023, 1), at(2023, 4), 4), ("A", at(2024, 2), at(2024, 3), 2), ("B", at(2023, 1), at(2024, 1), 5),
        ("B", at(2024, 3), at(2024, 4), 2), ("C", at(2023, 1), at(2024, 4), 8)]
    assert G.gap_intervals(rep.where("false"), "t", universe=universe).count() == 0
    assert G.quarterly_gaps(rep, "t", universe=universe).count() == 21


@pytest.mark.parametrize("block", [1, 3, 64])
def test_ema_scan_equals_the_recursion(spark, block):
    rng = np.random.default_rng(5)
    rows = [(k, i, None if rng.random() < 0.2 or i < lead else float(rng.normal(50, 20)), i * 2)
            for k, n, lead in (("A", 150, 0), ("B", 7, 5), ("C", 4, 9), ("D", 1, 0)) for i in range(n)]
    out = ema_features(spark.createDataFrame(rows, "k string, t int, x double, kept int"), "k", "t", "x", spans=(12, 26, 3), keep=("kept",), block=block).toPandas()
    want = pd.DataFrame(rows, columns=["k", "t", "x", "kept"]).sort_values(["k", "t"]).reset_index(drop=True)
    out = out.sort_values(["k", "t"]).reset_index(drop=True)
    assert out["kept"].tolist() == want["kept"].tolist()
    for span in (12, 26, 3):
        a, by_hand = 2 / (span + 1), []
        for _, x in want.groupby("k")["x"]:
            e = None
            for v in x:
                e = e if pd.isna(v) else v if e is None else (1 - a) * e + a * v
                by_hand.append(np.nan if e is None else e)
        np.testing.assert_allclose(out[f"ema_{span}"].to_numpy(float), by_hand, rtol=1e-12)
    np.testing.assert_allclose(out["macd"], out["ema_12"] - out["ema_26"])


def test_ema_runs_without_python_or_a_join(spark):
    df = spark.createDataFrame([("A", 1, 1.0)], "k string, t int, x double").repartition(3, "k")
    plan = ema_features(df, "k", "t", "x")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Join" not in plan
    assert plan.split("== Physical Plan ==")[1].count("Exchange") == 1

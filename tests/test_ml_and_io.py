import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import load as L
from tidemark.operators import model as M
from tidemark.operators import quality as Q
from tidemark.operators import samples as S

D0 = dt.date(2026, 1, 1)


def _frame(spark, tickers, days, with_label=True, last_label_null=False):
    seq, tab = ["s1"], ["t1"]
    rows = []
    for t in tickers:
        for i in range(days):
            label = float(i) / 100 if with_label else None
            if last_label_null and i == days - 1:
                label = None
            rows.append((t, D0 + dt.timedelta(days=i), float(i), float(i) / 10, label))
    df = spark.createDataFrame(rows, "ticker string, trading_date date, s1 double, t1 double, y double")
    return df, S.FeatureSpec(sequence=tuple(seq), tabular=tuple(tab), target="y")


def test_time_split_fixture(spark):
    df = spark.createDataFrame([(str(D0 + dt.timedelta(days=i)), i) for i in range(10)], "trading_date string, VALUE long")
    df = df.withColumn("trading_date", F.col("trading_date").cast("date"))
    counts = {r["split"]: r["count"] for r in S.time_split(df, "2026-01-05", "2026-01-07").groupBy("split").count()
              .collect()}
    assert counts == {"train": 5, "val": 2, "test": 3}
    with pytest.raises(ValueError):
        S.time_split(df, "2026-01-07", "2026-01-05")


def test_sample_windows_counts(spark):
    df, spec = _frame(spark, ["AAA", "BBB"], 35)
    spec30 = S.FeatureSpec(sequence=spec.sequence, tabular=spec.tabular, target="y", window=30)
    assert S.sample_windows(df, spec30).count() == 12
    short, _ = _frame(spark, ["AAA"], 10)
    assert S.sample_windows(short, spec30).count() == 0
    lastnull, _ = _frame(spark, ["AAA"], 31, last_label_null=True)
    assert S.sample_windows(lastnull, spec30).count() == 1


def test_one_sample_values(spark):
    df, spec = _frame(spark, ["AAA"], 30)
    r = S.sample_windows(df, S.FeatureSpec(sequence=("s1",), tabular=("t1",), target="y", window=30)).first()
    assert r["sequence"][-1] == [29.0] and r["sequence"][0] == [0.0]
    assert r["tabular"] == [pytest.approx(2.9)] and r["target"] == pytest.approx(0.29)


def test_latest_window_fixture(spark):
    rows = [(t, D0 + dt.timedelta(days=i), float(v), float(i)) for t in ("AAA", "BBB")
            for i, v in enumerate([10, 20, 30, 40, 50])]
    df = spark.createDataFrame(rows, "ticker string, trading_date date, SEQ_COL double, TAB_COL double")
    spec = S.FeatureSpec(sequence=("SEQ_COL",), tabular=("TAB_COL",), target="none", window=3)
    got = {r["ticker"]: r for r in S.latest_window(df, spec).collect()}
    assert got["AAA"]["sequence"] == [[30.0], [40.0], [50.0]] and got["AAA"]["tabular"] == [4.0]
    spec5 = S.FeatureSpec(sequence=("SEQ_COL",), tabular=("TAB_COL",), target="none", window=6)
    assert S.latest_window(df, spec5).count() == 0


def test_feature_spec_rejects_overlap():
    with pytest.raises(ValueError):
        S.FeatureSpec(sequence=("a",), tabular=("a",))
    with pytest.raises(ValueError):
        S.FeatureSpec(sequence=("y",), tabular=("b",), target="y")


def test_null_rates_and_gate(spark):
    df = spark.createDataFrame([(1, 1), (None, 2), (3, 3), (4, 4)], "A int, B int")
    rates = {r["column"]: r["null_rate"] for r in Q.null_rates(df, ["A", "B"]).collect()}
    assert rates == {"A": 0.25, "B": 0.0}
    assert Q.null_gate(df, ["A", "B"], 0.3) == rates
    with pytest.raises(ValueError):
        Q.null_gate(spark.createDataFrame([(None, 1), (None, 2), (None, 3), (4, 4)], "A int, B int"), ["A"], 0.2)
    with pytest.raises(ValueError):
        Q.null_gate(df.limit(0), ["A"], 0.2)


def test_key_report(spark):
    df = spark.createDataFrame([("A", 1), ("A", 1), ("B", None)], "k string, d int")
    r = Q.key_report(df, ["k", "d"]).first()
    assert (r["n_rows"], r["null_key_rows"], r["duplicate_keys"]) == (3, 1, 1)


def test_metrics_and_promotion(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 1.0)], "prediction double, target double")
    r = M.rmse_mae(df).first()
    assert r["rmse"] == pytest.approx(math.sqrt((1 + 4) / 2)) and r["mae"] == pytest.approx(1.5)
    assert M.promote({"rmse": 0.1}, None)
    assert M.promote({"rmse": 0.09}, {"rmse": 0.10}, 0.05)
    assert not M.promote({"rmse": 0.099}, {"rmse": 0.10}, 0.05)
    assert not M.promote({"rmse": 0.2}, {"rmse": 0.10}, 0.05)
    assert M.promote({"rmse": -1.0}, {"rmse": 0.0}, 0.05)
    with pytest.raises(ValueError):
        M.promote(None, {"rmse": 0.1})


def test_fit_and_score(spark):
    df, _ = _frame(spark, ["AAA", "BBB"], 40)
    spec = S.FeatureSpec(sequence=("s1",), tabular=("t1",), target="y", window=5)
    samples = S.sample_windows(df, spec)
    model = M.fit_regressor(samples, max_iter=10)
    scored = M.score(model, S.latest_window(df, spec))
    assert scored.count() == 2 and set(scored.columns) == {"ticker", "trading_date", "predicted_return"}


def test_bronze_load_is_idempotent(spark, tmp_dir):
    df = spark.createDataFrame([("A", "1"), ("B", "2")], "ticker string, close string")
    path = os.path.join(tmp_dir, "bronze")
    assert L.load_bronze(df, path, "2026-01-01", "landing/x.parquet") == 2
    assert L.load_bronze(df, path, "2026-01-01", "landing/x.parquet") == 2
    assert L.load_bronze(df.limit(1), path, "2026-01-02", "landing/y.parquet") == 1
    t = spark.read.parquet(path)
    assert t.count() == 3 and {str(r[0]) for r in t.select("part_key").distinct().collect()} == {"2026-01-01", "2026-01-02"}


def test_payload_roundtrip_and_publish(spark, tmp_dir):
    lines = spark.createDataFrame([('{"ticker": "A", "predicted_return": 0.01}',), ("",), ("{bad",),
                                   ('{"ticker": "B", "predicted_return": -0.02}',)], "value string")
    preds = L.parse_predictions(lines)
    assert preds.count() == 2
    rows = L.forecast_rows(preds, "2026-06-22", "v1")
    path = os.path.join(tmp_dir, "forecast")
    assert L.publish_forecast(rows, path) == 2
    assert L.publish_forecast(rows, path) == 2
    assert spark.read.parquet(path).count() == 2
    assert str(rows.schema["predicted_return"].dataType) == "DecimalType(18,6)"

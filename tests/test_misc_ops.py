import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import fill0, matches_all, matches_any_upper, ratio, require, row_count, safe_div
from tidemark.operators import load as L
from tidemark.operators import model as M
from tidemark.operators.quality import check_schema, run_checks
from tidemark.schemas import feed
from tidemark.streaming.landing import backfill


def test_check_schema_and_gate(spark):
    df = spark.createDataFrame([("A", 1)], "ticker string, n int")
    expected = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("n", T.LongType()),
                             T.StructField("x", T.DoubleType())])
    assert check_schema(df, expected) == ["n: int != bigint", "missing x"]
    assert run_checks(df, ["ticker"])["n_rows"] == 1
    assert run_checks(df, ["ticker"], skip=True) is None


def test_row_count_without_second_scan(spark):
    df, obs = row_count(spark.range(7))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 7


def test_column_helpers(spark):
    df = spark.createDataFrame([("Gasoline 95 Singapore", 4.0, 0.0, None)], "n string, a double, b double, c double")
    r = df.select(matches_all("n", ["%Gasoline%", "%Singapore%"]).alias("m"),
                  matches_any_upper("n", ["%DIVIDEND%", "%GASOLINE%"]).alias("u"),
                  ratio("a", "b").alias("r"), safe_div("a", "b").alias("s"), ratio("a", "a", minus1=True).alias("g"),
                  ).first()
    assert (r["m"], r["u"], r["r"], r["s"], r["g"]) == (True, True, None, None, 0.0)
    assert require(df, ["c"]).count() == 0
    assert fill0(df, ["c"]).first()["c"] == 0.0


def test_registry_rows(spark):
    reg = M.registry_row(spark, "v1", {"rmse": 0.1, "mae": 0.05}, "active").unionByName(
        M.registry_row(spark, "v2", {"rmse": 0.09, "mae": 0.04}))
    assert [r["version"] for r in M.active_champion(reg).collect()] == ["v1"]


def test_backfill_reloads_given_dates(spark, tmp_dir):
    cols = feed("interest_rates").bronze_columns
    landing = os.path.join(tmp_dir, "landing", "interest_rates")
    for day, v in (("2026-01-01", "1"), ("2026-01-02", "2")):
        spark.createDataFrame([("^IRX", day, v)], ", ".join(f"{c} string" for c in cols)).write.parquet(
            os.path.join(landing, f"batch_date={day}"))
    bronze_root = os.path.join(tmp_dir, "bronze")
    backfill(spark, os.path.join(tmp_dir, "landing"), bronze_root, ["interest_rates"], ["2026-01-02"])
    out = spark.read.parquet(os.path.join(bronze_root, "interest_rates"))
    assert [r["rate_value"] for r in out.collect()] == ["2"]


def test_append_partitioned_csv(spark, tmp_dir):
    df = spark.createDataFrame([("A", "2026-01-01", 1), ("B", "2026-01-02", 2)], "t string, d string, v int")
    path = os.path.join(tmp_dir, "csv")
    L.append_partitioned(df, path, ["d"])
    L.append_partitioned(df.where(F.col("t") == "A"), path, ["d"])
    assert spark.read.option("header", True).csv(path).count() == 3


def test_register_candidate_promotes_and_retires(spark):
    reg, ok = M.register_candidate(spark, None, "v1", {"rmse": 0.10, "mae": 0.05})
    assert ok
    reg, ok = M.register_candidate(spark, reg, "v2", {"rmse": 0.099, "mae": 0.05})
    assert not ok
    reg, ok = M.register_candidate(spark, reg, "v3", {"rmse": 0.08, "mae": 0.04})
    assert ok
    status = {r["version"]: r["status"] for r in reg.collect()}
    assert status == {"v1": "retired", "v2": "rejected", "v3": "active"}

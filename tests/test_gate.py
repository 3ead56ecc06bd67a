"""Write, audit, publish; row numbers of files; windows in blocks."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import gate as G
from tidemark.operators import load as L
from tidemark.operators import samples as S
from tidemark.operators.numbering import number_rows
from tidemark.operators.sample_blocks import block_windows, sample_blocks

SCHEMA = "k bigint, v string"


def _batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_only_batches_that_pass_are_seen(spark, tmp_dir):
    gate = G.Gate(["k"], ["v"], 0.5, T._parse_datatype_string(SCHEMA))
    shown = lambda: sorted((r["batch"], r["k"], r["v"]) for r in G.published(spark, tmp_dir, gate.declared).collect())
    assert shown() == []
    assert G.gated_publish(_batch(spark, [(1, "a"), (2, None)]), tmp_dir, "d1", gate)
    assert not G.gated_publish(_batch(spark, [(1, "a"), (1, "b"), (None, "c")]), tmp_dir, "d2", gate)
    assert not G.gated_publish(_batch(spark, [(1, None), (2, None), (3, "x")]), tmp_dir, "d3", gate)
    assert not G.gated_publish(_batch(spark, []), tmp_dir, "d4", gate)
    assert not G.gated_publish(spark.createDataFrame([(1, 2)], "k int, w int"), tmp_dir, "d5", gate)
    assert shown() == [("d1", 1, "a"), ("d1", 2, None)]
    found = {r["batch"]: (r["n_rows"], r["null_key_rows"], r["duplicate_keys"], r["problems"]) for r in G.reports(spark, tmp_dir).collect()}
    assert found == {
        "d1": (2, 0, 0, []), "d2": (3, 1, 1, ["NULL in a key", "repeated keys"]), "d3": (3, 0, 0, ["NULLs in v"]), "d4": (0, 0, 0, ["no rows"]),
        "d5": (1, 0, 0, ["k: int != bigint", "missing v"])}
    assert G.kept_aside(spark, tmp_dir, "d1") is None
    assert G.kept_aside(spark, tmp_dir, "d2").count() == 3
    # a mended batch replaces its stage and its report, an agreed one goes through
    assert G.gated_publish(_batch(spark, [(7, "a")]), tmp_dir, "d2", gate)
    assert G.gated_publish(_batch(spark, [(1, None), (1, None)]), tmp_dir, "d3", gate, skip=True)
    assert G.kept_aside(spark, tmp_dir, "d2") is None
    assert shown() == [("d1", 1, "a"), ("d1", 2, None), ("d2", 7, "a"), ("d3", 1, None), ("d3", 1, None)]
    # a failing re-delivery leaves what is published; an agreed empty one removes it
    assert not G.gated_publish(_batch(spark, []), tmp_dir, "d1", gate)
    assert [r[0] for r in shown()] == ["d1", "d1", "d2", "d3", "d3"]
    assert G.gated_publish(_batch(spark, []), tmp_dir, "d1", gate, skip=True)
    assert [r[0] for r in shown()] == ["d2", "d3", "d3"]
    assert G.reports(spark, tmp_dir).count() == 5


@pytest.mark.parametrize("kind", ["text", "csv", "json", "parquet"])
def test_numbers_without_gaps_over_many_splits(spark, tmp_dir, kind):
    for place, n in (("a", 3000), ("b", 1), ("c", 700)):
        rows = spark.range(n).select(F.format_string("%s-%06d", F.lit(place), "id").alias("value")).coalesce(1).sortWithinPartitions("value")
        rows.write.format(kind).save(os.path.join(tmp_dir, place))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        files = spark.read.schema("value string").format(kind).option("recursiveFileLookup", "true").load(tmp_dir)
        assert files.rdd.getNumPartitions() > 3
        got = number_rows(files).collect()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert len(got) == 3701
    assert all(r["src_row"] == int(r["value"].split("-")[1]) for r in got)
    assert len({r["src_file"] for r in got}) == 3


def test_numbers_need_a_file(spark):
    with pytest.raises(ValueError, match="file source"):
        number_rows(spark.range(3))
    assert L.with_lineage(spark.range(3), "2026-01-01", "given").select("src_row").distinct().count() == 3


def _features(spark, sizes):
    spec = S.FeatureSpec(sequence=("x", "y"), tabular=("z",), target="t", window=4)
    rows = [(k, i, float(i), None if i % 5 == 0 else i / 2, -float(i), None if i % 11 == 3 else float(i)) for k, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "ticker string, trading_date int, x double, y double, z double, t double"), spec


@pytest.mark.parametrize("length", [3, 4, 5, 8, 1000])
@pytest.mark.parametrize("fill", [0.0, None])
def test_blocks_hold_the_same_windows(spark, tmp_dir, length, fill):
    df, spec = _features(spark, {"A": 50, "B": 3, "C": 4, "D": 8, "E": 9, "F": 1})
    want = S.sample_windows(df, spec, fill)
    key = lambda r: (r["ticker"], r["trading_date"], str(r))
    assert sorted(block_windows(sample_blocks(df, spec, fill, length), spec).collect(), key=key) == sorted(want.collect(), key=key)
    assert L.write_samples(df, tmp_dir, spec, fill, length) == want.count()
    assert sorted(L.read_samples(spark, tmp_dir, spec).collect(), key=key) == sorted(want.collect(), key=key)


def test_blocks_hold_each_row_about_once(spark):
    df, spec = _features(spark, {"A": 2000})
    rows = df.where("t is not null").count()
    held = sample_blocks(df, spec, length=100).selectExpr("sum(size(sequence)) s", "sum(size(target)) t", "max(size(sequence)) m").first()
    assert held["t"] == rows and held["s"] <= rows * 1.04 and held["m"] == 103
    assert sample_blocks(df.where("false"), spec).count() == 0
    with pytest.raises(ValueError, match="overlap"):
        sample_blocks(df, spec, length=2)

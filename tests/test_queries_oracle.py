"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

SF = os.environ.get("TIDEMARK_TEST_SF", "/root/testdata/sf0.001")

from tidemark.plans.catalog import ORACLE, QUERIES, load_all  # noqa: E402

load_all()


@pytest.fixture(scope="module")
def duck():
    from oracle_check import duck as mk

    return mk(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    from oracle_check import compare

    r = compare(spark, duck, name, QUERIES[name], ORACLE[name], SF)
    assert r.get("cols_ok"), r
    assert r.get("ok"), r


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_entry_smoke(spark):
    import importlib

    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidemark.session import ENGINE_CONF, ensure_checkpoint_dir

    b = SparkSession.builder.master("local[4]").appName("tidemark-tests").config("spark.sql.shuffle.partitions", "4")
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    # tests own their checkpoint folder (a cluster names a shared one in spark.checkpoint.dir)
    b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-test-ckpt-", dir="/tmp"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidemark-test-", dir="/tmp")

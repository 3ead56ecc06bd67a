"""Session construction and cluster-safe helpers (checkpoint dir, size checks)."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings the engine relies on.  Timestamps are compared against other
# engines and published as dates, so the session time zone is pinned.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keep small-but-CPU-heavy window stages spread over the cores
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
}

# Upper bound for a side we hint as broadcast.  Anything larger is left to the
# planner (sort-merge, or an AQE runtime switch once real sizes are known).
BROADCAST_LIMIT_BYTES = 16 * 1024 * 1024


def get_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in ENGINE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEM", "8g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors once per application.

    Functions run by Python workers are pickled by module name, so the workers
    must be able to import the package even where only the driver has it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="tidemark-"), "tidemark.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(archive)
    sc._tidemark_shipped = True


def ensure_utc(spark: SparkSession) -> None:
    """Dates are derived from timestamps; pin the zone if the caller did not."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared store (HDFS / object store) and is
    used as-is.  Only when it is unset and the master is local do we create
    one: executors of a cluster do not share the driver's disk.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        path = configured
    elif not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    else:
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir="/tmp")
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # noqa: BLE001 - a core conf may be read-only at run time
            pass
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


def _store(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table or file is there; a store that cannot be read raises."""
    p, fs = _store(spark, path)
    return fs.exists(p)


def list_path(spark: SparkSession, path: str) -> list:
    p, fs = _store(spark, path)
    return list(fs.listStatus(p))


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _store(spark, path)
    fs.delete(p, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate for ``df`` (None when the plan offers none)."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - connect sessions / exotic plans
        return None


def small_side(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint ``df`` as broadcast only when its estimated size is under ``limit``.

    Above the limit (or with no estimate) the plain frame is returned and the
    join falls back to a shuffle join; AQE may still switch to broadcast at
    run time from measured shuffle sizes.
    """
    size = estimated_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df

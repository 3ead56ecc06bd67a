"""Small shared helpers: table reads, folds, shared folders, batches of whole texts."""

from __future__ import annotations

import contextlib
import gc
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ensure_checkpoint_dir, ship_package


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows in one Arrow batch between Spark and a Python worker.  Spark's default of 10,000 holds tens of MB
#: of long texts on both sides at once; this many keep a batch to a few MB.
BATCH_ROWS = "1000"
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """What the operators need of a session: the package on its workers, and small batches unless the user set their size."""
    ship_package(spark)
    if spark.conf.get(_BATCH_CONF) == "10000":
        spark.conf.set(_BATCH_CONF, BATCH_ROWS)


@contextlib.contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """For what runs inside, at most so many rows in one Arrow batch: rows that are blocks are large."""
    before = spark.conf.get(_BATCH_CONF)
    spark.conf.set(_BATCH_CONF, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_CONF, before)


def fold(id_col: str | Column, n: int) -> Column:
    """crc32 of the id as text modulo n; a null id counts as the empty text."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run under ``spark.checkpoint.dir`` (shared by all executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Shuffle files that no plan needs any more go when the driver collects its garbage: now rather than some time later."""
    gc.collect()
    time.sleep(1.5)  # py4j lets go of Java objects up to a second after Python did; a collection before that would only age them
    spark.sparkContext._jvm.System.gc()


def no_rows(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """An empty table by the JVM alone; ``createDataFrame([])`` starts a second Python daemon with workers of its own on every executor."""
    fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])


def partitions_for(df_bytes: float, target_bytes: float, least: int = 1) -> int:
    return max(least, int(df_bytes // target_bytes) + 1)


def slices(batch: pa.RecordBatch, text: str, max_chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut an Arrow batch into runs of whole rows of about ``max_chars`` (at least one row)."""
    col = batch.column(batch.schema.get_field_index(text))
    start, size = 0, 0
    for i, v in enumerate(col):
        size += len(v.as_buffer()) if v.is_valid else 0
        if size >= max_chars:
            yield batch.slice(start, i + 1 - start)
            start, size = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)

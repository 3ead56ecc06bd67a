"""New-file arrival -> bronze -> silver with Structured Streaming (STR1-STR7).

A file-source stream discovers landing files (its checkpoint is the cursor) and
``foreachBatch`` loads them.  The unit of a load is the *file*, never the batch
date.  A load writes its files' rows under a folder of its own (``part_key`` and a
``load_id`` that follows from the set of files), and only then the register: one record
per file with its rows.  A file is held if the register says so, never because some of
its rows are there.  A load that broke off between part files left no record: its replay
has the same files, hence the same folder, and replaces what is there.  So a date that
arrives in several micro-batches, a late file, a replay and a broken load all end with
every row exactly once.  Rows that name no source file or batch date go to a dead-letter
table in the same micro-batch, with the reason.

Silver takes only the rows of the micro-batch (they carry the newest load time, so
latest load wins) and merges them into the partitions they touch.  The merged
partitions are staged under the batch's own path before any of them is replaced;
a replay that finds them complete re-applies them instead of merging again, so a
failure midway loses nothing.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.silver import to_silver
from tidemark.operators.upsert import reject_null_keys, upsert_partitions
from tidemark.schemas import feed
from tidemark.session import delete_path, list_path, path_exists, small_side

log = logging.getLogger(__name__)

MAX_FILES_PER_TRIGGER = 30  # size of a micro-batch; what is over waits for the next one
POLL = "60 seconds"
KEY_BUCKETS = 32
PART = "part"


def stream_landing(spark: SparkSession, landing_dir: str, schema: T.StructType,
                   max_files: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """STR1: new landing files, oldest first, at most ``max_files`` per trigger.
    ``batch_date`` comes from the ``batch_date=`` directory; the file path is kept."""
    full = T.StructType(list(schema.fields) + [T.StructField("batch_date", T.DateType(), True)])
    return (spark.readStream.schema(full).option("maxFilesPerTrigger", max_files)
            .option("latestFirst", False).parquet(landing_dir)
            .withColumn("src_file", F.col("_metadata.file_path")))


def _incomplete() -> Column:
    return F.col("src_file").isNull() | F.col("batch_date").isNull()


def drop_incomplete(df: DataFrame, obs: Observation | None = None) -> DataFrame:
    """STR4: rows without a source file or batch date are skipped (counted)."""
    if obs is not None:
        df = df.observe(obs, F.count_if(_incomplete()).alias("skipped"))
    return df.where(~_incomplete())


def with_load_columns(rows: DataFrame) -> DataFrame:
    return rows.select("*", F.col("batch_date").cast("string").alias("part_key"),
                       F.monotonically_increasing_id().alias("src_row"), F.current_timestamp().alias("loaded_at"))


REGISTER = "src_file string, part_key string, rows long, load_id string, batch_id long, loaded_at timestamp"


def register_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}.register"


def dead_letter_path(bronze_path: str) -> str:
    return f"{bronze_path.rstrip('/')}.dead_letters"


def register(spark: SparkSession, bronze_path: str) -> DataFrame | None:
    """The committed files of a bronze table; None before the first load."""
    path = register_path(bronze_path)
    return spark.read.schema(REGISTER).parquet(path) if path_exists(spark, path) else None


def committed(spark: SparkSession, bronze_path: str) -> DataFrame:
    """Bronze rows of committed loads only, also while another one is being written."""
    loads = register(spark, bronze_path)
    rows = spark.read.parquet(bronze_path).withColumn("part_key", F.col("part_key").cast("string"))
    return rows if loads is None else rows.join(small_side(loads.select("load_id").distinct()), "load_id", "left_semi")


def dead_letters(batch: DataFrame, batch_id: int) -> DataFrame:
    """STR4: the rows of a micro-batch that can't be loaded, with the reason."""
    reason = F.when(F.col("src_file").isNull(), "no source file").otherwise("no batch date")
    return batch.where(_incomplete()).withColumns({"reason": reason, "rejected_at": F.current_timestamp(), "batch_id": F.lit(batch_id).cast("long")})


def load_batch_fn(bronze_path: str) -> Callable[[DataFrame, int], None]:
    """STR3: add the files of one micro-batch that are not in the register yet, then register them."""

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        obs = Observation(f"landing-{batch_id}")
        rejected = dead_letters(batch, batch_id).observe(obs, F.count(F.lit(1)).alias("rows"))
        # a replay of the micro-batch replaces its own rows
        rejected.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(dead_letter_path(bronze_path))
        if obs.get["rows"]:
            log.warning("micro-batch %s: %s rows without source file or batch date kept aside", batch_id, obs.get["rows"])
        rows = with_load_columns(drop_incomplete(batch))
        held = register(spark, bronze_path)
        if held is not None:
            rows = rows.join(held.select("part_key", "src_file"), ["part_key", "src_file"], "left_anti")
        files = rows.groupBy("src_file", "part_key").agg(F.count(F.lit(1)).alias("rows"))
        # the set of files names the load: one number reaches the driver
        mark, n = files.agg(F.expr("bit_xor(xxhash64(src_file, part_key))"), F.count(F.lit(1))).head()
        if not n:
            return
        load_id = f"{mark & (1 << 64) - 1:016x}"
        # part_key is known to have few values; with load_id as a constant each load has folders of its own
        rows.withColumn("load_id", F.lit(load_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "part_key", "load_id").parquet(bronze_path)
        record = files.withColumns({"load_id": F.lit(load_id), "batch_id": F.lit(batch_id).cast("long"), "loaded_at": F.current_timestamp()})
        record.select(*[c.split()[0] for c in REGISTER.split(", ")]).coalesce(1).write.mode("append").parquet(register_path(bronze_path))

    return load


def silver_partition(feed_name: str) -> Column:
    """Partition of a silver row, a function of its key: month of a date key, year of
    a statement, else a bucket of the key.  A batch rewrites only what it touches."""
    f = feed(feed_name)
    kinds = dict(f.columns)
    for k in f.keys:
        if kinds[k] == "D":
            return F.date_format(k, "yyyy-MM")
        if kinds[k] == "I":
            return F.concat(F.lit("y"), F.col(k).cast("string"))
    return F.concat(F.lit("b"), F.pmod(F.xxhash64(*f.keys), F.lit(KEY_BUCKETS)).cast("string"))


def refresh_silver(rows: DataFrame, silver_path: str, feed_name: str, batch_id: int | str, job: str = "stream") -> None:
    """STR5/STR6: merge bronze-shaped ``rows`` into silver (latest load wins, created_* kept)."""
    spark = rows.sparkSession
    staged = f"{silver_path.rstrip('/')}.staging/batch={batch_id}"
    if not path_exists(spark, f"{staged}/_SUCCESS"):
        f = feed(feed_name)
        new = reject_null_keys(to_silver(rows, feed_name, job=job), f.keys).withColumn(PART, silver_partition(feed_name))
        # a missing table is the first build; any other read error is raised
        if path_exists(spark, silver_path):
            old = spark.read.parquet(silver_path).withColumn(PART, F.col(PART).cast("string"))
            new = upsert_partitions(old, new, [*f.keys, PART], [PART])
        new.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(PART).parquet(staged)
    # an empty batch stages no partition and replaces none
    if any(s.isDirectory() for s in list_path(spark, staged)):
        merged = spark.read.parquet(staged).withColumn(PART, F.col(PART).cast("string"))
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(silver_path)
    delete_path(spark, staged)


def start_landing_stream(spark: SparkSession, landing_dir: str, bronze_path: str, checkpoint: str,
                         feed_name: str, silver_path: str | None = None, available_now: bool = True,
                         poll: str = POLL, max_files: int = MAX_FILES_PER_TRIGGER) -> StreamingQuery:
    """STR1-STR5 wired together.  ``available_now`` processes everything that
    has arrived and stops (backfill, tests); otherwise polls every ``poll``."""
    f = feed(feed_name)
    src = stream_landing(spark, landing_dir, f.bronze_schema(), max_files)
    loader = load_batch_fn(bronze_path)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            loader(batch, batch_id)
            if silver_path:
                refresh_silver(with_load_columns(drop_incomplete(batch)), silver_path, feed_name, batch_id)
        finally:
            batch.unpersist()

    w = src.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=poll)
    return w.start()


def backfill(spark: SparkSession, landing_root: str, bronze_root: str, feeds: list[str], dates: list[str]) -> None:
    """STR7: load the files of the given ``batch_date`` partitions that bronze lacks, for several feeds."""
    for name in feeds:
        schema = feed(name).bronze_schema()
        src = spark.read.schema(T.StructType(list(schema.fields) + [T.StructField("batch_date", T.DateType())])) \
            .parquet(f"{landing_root}/{name}").where(F.col("batch_date").cast("string").isin(dates)) \
            .withColumn("src_file", F.col("_metadata.file_path"))
        load_batch_fn(f"{bronze_root}/{name}")(src, -1)

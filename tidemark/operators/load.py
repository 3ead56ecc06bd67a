"""Landing writes, bronze loads, exports and publishing (SNK1-SNK6, SNK10-SNK15).

All writes are idempotent by construction: a re-run replaces exactly the
partition it produced (dynamic partition overwrite), never appends twice.
Row counts come from ``Observation`` metrics collected during the write, so
no second scan is needed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.numbering import number_rows
from tidemark.operators.sample_blocks import BLOCK, block_windows, sample_blocks
from tidemark.operators.samples import FeatureSpec
from tidemark.schemas import LINEAGE_COLUMNS
from tidemark.session import delete_path, path_exists


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_landing(df: DataFrame, root: str, table: str, batch_date: str | dt.date) -> int:
    """SNK1/SNK2: snappy Parquet under ``<root>/<table>/batch_date=<d>/``; a re-run
    replaces that batch only.  Empty input writes nothing and returns 0."""
    if df.isEmpty():
        return 0
    out, obs = _counted(df.withColumn("batch_date", F.lit(str(batch_date)).cast("date")), f"landing_{table}")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
     .partitionBy("batch_date").parquet(f"{root.rstrip('/')}/{table}"))
    return int(obs.get["rows"])


def with_lineage(df: DataFrame, batch_date: str | dt.date | None, src_file: str | None = None) -> DataFrame:
    """SNK5: batch date, source file, row, the partition key and the load time.  Rows straight from a
    file source get the scan's file and their number in it (``number_rows``); rows from elsewhere get
    ``src_file`` and an id unique within the load."""
    bd = F.lit(str(batch_date)).cast("date") if batch_date else F.lit(None).cast("date")
    pk = F.lit(str(batch_date)) if batch_date else F.lit(None).cast("string")
    if src_file:
        rows = df.select("*", F.lit(src_file).alias("src_file"), F.monotonically_increasing_id().alias("src_row"))
    else:
        rows = number_rows(df)
    own = [F.col(f"`{c}`") for c in df.columns]
    return rows.select(*own, bd.alias("batch_date"), "src_file", "src_row", pk.alias("part_key"), F.current_timestamp().alias("loaded_at"))


def load_bronze(df: DataFrame, path: str, batch_date: str | dt.date | None, src_file: str | None = None) -> int:
    """SNK3/SNK4/SNK6: with a batch date, replace only ``part_key=<d>``; without
    one, reload the whole table.  A batch without rows empties its partition: what an
    earlier delivery left there goes, as in delete-then-insert.  Returns the rows loaded."""
    staged, obs = _counted(with_lineage(df, batch_date, src_file), "bronze_load")
    w = staged.write.partitionBy("part_key")
    if batch_date is None:
        w.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    else:
        w.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    rows = int(obs.get["rows"])
    if batch_date is not None and not rows:
        drop_partition(df.sparkSession, path, "part_key", batch_date)
    return rows


def drop_partition(spark: SparkSession, path: str, column: str, value: str | dt.date) -> None:
    """Remove one partition of a table, if it is there; an overwrite without rows touches none."""
    folder = f"{path.rstrip('/')}/{column}={value}"
    if path_exists(spark, folder):
        delete_path(spark, folder)


def export_training(df: DataFrame, path: str) -> int:
    """SNK10: overwrite the export; zero rows is an error (the export is kept empty)."""
    out, obs = _counted(df, "export")
    out.write.mode("overwrite").parquet(path)
    n = int(obs.get["rows"])
    if n == 0:
        raise ValueError("export produced no rows")
    return n


def payloads(windows: DataFrame) -> DataFrame:
    """SNK11 body: one JSON line ``{ticker, sequence, tabular}`` per window."""
    return windows.select(F.to_json(F.struct("ticker", "sequence", "tabular")).alias("value"))


def write_payloads(windows: DataFrame, path: str) -> None:
    payloads(windows).write.mode("overwrite").text(path)


PREDICTION_SCHEMA = "ticker string, predicted_return double"


def parse_predictions(lines: DataFrame, col: str = "value") -> DataFrame:
    """SNK12: parse JSON lines; blank and malformed lines are skipped."""
    parsed = lines.where(F.trim(F.col(col)) != "").select(
        F.from_json(F.col(col), PREDICTION_SCHEMA, {"mode": "PERMISSIVE"}).alias("p"))
    return parsed.where(F.col("p.ticker").isNotNull() & F.col("p.predicted_return").isNotNull()).select("p.*")


def read_predictions(spark, path: str) -> DataFrame:
    df = parse_predictions(spark.read.text(path))
    if df.isEmpty():
        raise ValueError(f"no valid predictions under {path}")
    return df


def forecast_rows(preds: DataFrame, forecast_date, model_version: str, job: str = "forecast") -> DataFrame:
    """SNK13 body: forecast table rows with decimal(18,6) returns and audit columns."""
    from tidemark.operators.silver import with_audit

    from pyspark.sql import Column

    d = forecast_date if isinstance(forecast_date, Column) else F.lit(str(forecast_date)).cast("date")
    rows = preds.select(
        "ticker", d.alias("trading_date"), F.col("predicted_return").cast("decimal(18,6)").alias("predicted_return"),
        F.lit(model_version).alias("model_version"))
    return with_audit(rows, job, None).drop("batch_date").withColumn("batch_date", F.col("trading_date"))


def publish_forecast(rows: DataFrame, path: str, forecast_date: str | dt.date | None = None) -> int:
    """SNK13: replace the forecast date's partition (delete + insert in one
    atomic partition swap); a re-run of the same date is a no-op in effect.  With
    ``forecast_date``, a run without rows empties that date's partition."""
    out, obs = _counted(rows, "publish")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("trading_date")
     .parquet(path))
    n = int(obs.get["rows"])
    if forecast_date is not None and not n:
        drop_partition(rows.sparkSession, path, "trading_date", forecast_date)
    return n


def append_partitioned(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """SNK14: append CSV files per (key values)."""
    df.write.mode("append").option("header", True).partitionBy(*keys).csv(path)


def write_samples(df: DataFrame, path: str, spec: FeatureSpec = FeatureSpec(), fill: float | None = 0.0, length: int = BLOCK) -> int:
    """SNK15: the samples of a feature table, each row once but for the overlap of blocks
    (``sample_blocks``).  Returns the samples written."""
    blocks = sample_blocks(df, spec, fill, length)
    obs = Observation("samples")
    full = F.size("target") - F.greatest(F.lit(spec.window - 1) - F.col("lead"), F.lit(0))
    blocks.observe(obs, F.sum(F.greatest(full, F.lit(0))).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get["rows"] or 0)


def read_samples(spark: SparkSession, path: str, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """The samples that ``write_samples`` wrote, as ``sample_windows`` gives them."""
    return block_windows(spark.read.parquet(path), spec)


__all__ = ["LINEAGE_COLUMNS"]

"""End-to-end jobs composed from the operators.

* ``refresh_layers``  - bronze table -> silver upsert for one feed (entry A, steps 5-6)
* ``build_feature_table`` - marts + wide fact table, written once (entry A, step 7)
* ``train``           - export, auto cut dates, windows per split, fit, evaluate, promote (entry C)
* ``daily_forecast``  - gate, look-back, latest windows, score, publish (entry B)

Everything stays distributed: only scalars (cut dates, metrics, the gate's
per-column rates) reach the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import next_weekday
from tidemark.operators import load as L
from tidemark.operators import model as M
from tidemark.operators import quality as Q
from tidemark.operators import samples as S
from tidemark.operators.silver import to_silver
from tidemark.operators.upsert import reject_null_keys, upsert
from tidemark.schemas import feed
from tidemark.session import cut_lineage, path_exists
from tidemark.sources.readers import latest_slice, lookback_slice


def refresh_layers(spark: SparkSession, bronze: DataFrame, silver_path: str | None, feed_name: str,
                   part_key: str | None = None, job: str = "silver", batch_date=None) -> DataFrame:
    """Bronze (optionally one load partition) -> typed silver merged into the
    existing silver table.  Returns the merged frame (caller writes it to a new
    version directory; see ``operators.upsert.write_upsert``)."""
    new = to_silver(bronze, feed_name, job=job, batch_date=batch_date, part_key=part_key)
    if silver_path is None:
        return new
    new = reject_null_keys(new, feed(feed_name).keys)
    if not path_exists(spark, silver_path):  # first build; a table that cannot be read raises
        return new
    return upsert(spark.read.parquet(silver_path), new, feed(feed_name).keys)


def build_feature_table(spark: SparkSession, sf_dir: str, out_path: str | None = None) -> DataFrame:
    """All marts + the wide table.  When ``out_path`` is given the table is written
    there (Parquet, partitioned by year) and read back, cutting the lineage for
    the training and scoring steps; otherwise it is checkpointed."""
    from tidemark.plans.queries_features import build_fact

    fact = build_fact(spark, sf_dir)
    if out_path is None:
        return cut_lineage(fact)
    # static: a rebuild replaces the whole table, also years that are gone
    (fact.withColumn("year", F.year("trading_date")).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy("year").parquet(out_path))
    return spark.read.parquet(out_path).drop("year")


def train(fact: DataFrame, spec: S.FeatureSpec = S.FeatureSpec(), champion: dict | None = None,
          threshold: float = 0.05, export_path: str | None = None, months: int | None = None,
          as_of: dt.date | None = None, registry: DataFrame | None = None, version: str | None = None) -> dict:
    """Entry C: optional export (SNK10/SRC11), cut dates (ML2), windows built
    inside each split (ML1/ML4), non-empty splits (ML5), fit (ML6), test metrics
    (ML7), promotion decision (ML9) -- against ``champion`` metrics, or against
    the active row of ``registry`` (ML10), which is returned updated."""
    from tidemark.sources.readers import months_back

    data = months_back(fact, spec.order, months, as_of)
    if export_path:
        L.export_training(data, export_path)
        data = fact.sparkSession.read.parquet(export_path)
    cuts = S.auto_cutoffs(data, spec.order, spec.target).first()
    if cuts is None or cuts["train_end"] is None or cuts["val_end"] is None:
        raise RuntimeError("could not resolve cut dates")
    split = S.time_split(data, cuts["train_end"], cuts["val_end"], spec.order)
    series = F.struct(F.col(spec.key).alias("key"), "split")
    samples = S.sample_windows(split.withColumn("__k", series),
                               S.FeatureSpec(spec.sequence, spec.tabular, spec.target, spec.window, "__k",
                                             spec.order))
    samples = samples.withColumn("split", F.col("__k.split")).withColumn(spec.key, F.col("__k.key")).drop("__k")
    samples = cut_lineage(samples)
    S.require_samples(S.split_counts(samples))
    model = M.fit_regressor(samples.where(F.col("split") == "train"))
    scored = model.transform(M.feature_vector(samples.where(F.col("split") == "test")))
    metrics = M.rmse_mae(scored).first().asDict()
    out = {"train_end": cuts["train_end"], "val_end": cuts["val_end"], "metrics": metrics, "model": model}
    if version is not None:
        out["registry"], out["promote"] = M.register_candidate(fact.sparkSession, registry, version, metrics,
                                                               threshold)
    else:
        out["promote"] = M.promote(metrics, champion, threshold)
    return out


def daily_forecast(fact: DataFrame, model: PipelineModel, model_version: str, publish_path: str | None = None,
                   spec: S.FeatureSpec = S.FeatureSpec(), null_threshold: float = 0.6,
                   lookback_days: int = 90) -> DataFrame:
    """Entry B: null-rate gate on the newest date (DQ5), 90-day look-back
    (SRC10), newest window per ticker (W26), scoring (ML8), forecast date = next
    weekday (F16), publish by replacing that date's partition (SNK13)."""
    newest = latest_slice(fact, spec.order)
    Q.null_gate(newest, list(spec.sequence) + list(spec.tabular), null_threshold)
    windows = S.latest_window(lookback_slice(fact, spec.order, days=lookback_days), spec)
    preds = M.score(model, windows)
    rows = L.forecast_rows(preds.select("ticker", "predicted_return"),
                           next_weekday(F.lit(fact.select(F.max(spec.order)).first()[0])), model_version)
    if publish_path:
        L.publish_forecast(rows, publish_path)
    return rows

"""Write, audit, publish (DQ4-DQ6): a batch is seen by readers only after its checks.

The batch is written to a stage of its own.  Rows, NULL counts and NULL keys are
``Observation`` metrics of that write; repeated keys are counted over the staged key columns
alone.  A batch that passes replaces its partition of the table from the staged files; one that
fails stays in its stage.  Either way a report row is kept, one per batch, so that a re-run
replaces the partition, the stage and the report of its batch and nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.load import drop_partition
from tidemark.operators.quality import check_schema, unique
from tidemark.session import delete_path, path_exists

REPORT = ("batch string, n_rows bigint, null_key_rows bigint, duplicate_keys bigint, worst_column string, worst_null_rate double, "
          "problems array<string>, published boolean")


@dataclass(frozen=True)
class Gate:
    """What a batch must hold: its keys, the columns whose share of NULLs is limited, and declared types (None: any)."""

    keys: Sequence[str]
    columns: Sequence[str] = ()
    null_limit: float = 0.6
    declared: T.StructType | None = None


def gated_publish(df: DataFrame, root: str, batch: str, gate: Gate, skip: bool = False) -> bool:
    """Publish ``df`` as partition ``batch`` of ``<root>/table`` if it passes; returns whether it was published.

    Problems are: a declared column missing or of another type, no rows, NULL in a key, repeated
    keys, a column above the NULL limit.  ``skip`` (DQ6) publishes all the same, with the problems
    in the report.  A batch of another schema than declared is staged as it is."""
    spark, stage = df.sparkSession, f"{root}/stage/{batch}"
    problems = check_schema(df, gate.declared) if gate.declared is not None else []
    keys, columns = ([c for c in cs if c in df.columns] for cs in (gate.keys, gate.columns))
    problems += [f"missing {c}" for c in (*gate.keys, *gate.columns) if c not in df.columns and f"missing {c}" not in problems]
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    obs = Observation(f"gate_{batch}")
    df.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(null_key).alias("null_keys"),
               *[F.count_if(F.col(c).isNull()).alias(f"null_{i}") for i, c in enumerate(columns)]).write.mode("overwrite").parquet(stage)
    seen = obs.get
    rows, null_keys = int(seen["rows"]), int(seen["null_keys"])
    staged = spark.read.schema(df.schema).parquet(stage)
    repeated = unique(staged, keys).count() if keys else 0
    rates = {c: seen[f"null_{i}"] / rows for i, c in enumerate(columns)} if rows else {}
    worst = min(rates, key=lambda c: (-rates[c], c)) if rates else None
    if not rows:
        problems.append("no rows")
    if null_keys:
        problems.append("NULL in a key")
    if repeated:
        problems.append("repeated keys")
    problems += [f"NULLs in {c}" for c in sorted(rates) if rates[c] > gate.null_limit]
    passed = skip or not problems
    if passed and rows:
        (staged.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(f"{root}/table"))
    elif passed:
        drop_partition(spark, f"{root}/table", "batch", batch)
    row = (batch, rows, null_keys, repeated, worst, rates.get(worst), problems, passed)
    (spark.createDataFrame([row], REPORT).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(f"{root}/report"))
    if passed:
        delete_path(spark, stage)
    return passed


def reports(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch that came to the gate."""
    return spark.read.schema(REPORT).parquet(f"{root}/report")


def published(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The rows of the batches that passed, with their batch; empty before the first."""
    whole = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    if not path_exists(spark, f"{root}/table"):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(f"{root}/table")


def kept_aside(spark: SparkSession, root: str, batch: str) -> DataFrame | None:
    """The staged rows of a batch that failed; None where there is none."""
    stage = f"{root}/stage/{batch}"
    return spark.read.parquet(stage) if path_exists(spark, stage) else None

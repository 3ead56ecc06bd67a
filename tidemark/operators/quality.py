"""Data-quality checks (DQ1-DQ6, AGG9, AGG11): one aggregate pass each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """AGG9: (column, null_rate) rows from a single aggregate over ``df``."""
    agg = df.agg(F.count(F.lit(1)).alias("__n"),
                 *[F.sum(F.col(c).isNull().cast("int")).alias(f"__null_{i}") for i, c in enumerate(columns)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), (F.col(f"__null_{i}") / F.col("__n")).alias("null_rate"))
        for i, c in enumerate(columns)
    ]))
    return agg.where(F.col("__n") > 0).select(stack.alias("r")).select("r.column", "r.null_rate")


def null_gate(df: DataFrame, columns: Sequence[str], threshold: float = 0.6) -> dict[str, float]:
    """DQ5: raise when the slice is empty or any column's null rate exceeds the
    threshold.  Only the per-column rates (one row per column) reach the driver."""
    rates = {r["column"]: float(r["null_rate"]) for r in null_rates(df, columns).collect()}
    if not rates:
        raise ValueError("cannot compute null rates on an empty slice")
    bad = {c: r for c, r in rates.items() if r > threshold}
    if bad:
        raise ValueError("null rate above {:.2%}: {}".format(
            threshold, ", ".join(f"{c}={r:.2%}" for c, r in bad.items())))
    return rates


def key_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ1-DQ3 in one row: rows, rows with a NULL key part, duplicate key groups.
    One grouping by the key (partial aggregation map-side), then a global sum."""
    any_null = None
    for k in keys:
        any_null = F.col(k).isNull() if any_null is None else any_null | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"), F.max(any_null).alias("nk"))
    return per_key.agg(
        F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("nk"), F.col("c"))), F.lit(0)).cast("bigint").alias("null_key_rows"),
        F.count_if(F.col("c") > 1).alias("duplicate_keys"),
    )


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """DQ1: NULL count per column (one pass)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ2/DQ3: key values that occur more than once."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def check_schema(df: DataFrame, expected: T.StructType) -> list[str]:
    """DQ4: differences between the declared and the actual column types."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for f in expected.fields:
        if f.name not in have:
            problems.append(f"missing {f.name}")
        elif have[f.name] != f.dataType:
            problems.append(f"{f.name}: {have[f.name].simpleString()} != {f.dataType.simpleString()}")
    return problems


def run_checks(df: DataFrame, keys: Sequence[str], *, skip: bool = False) -> dict[str, int] | None:
    """Key checks as a gate (DQ6 ``skip`` bypasses them).  Returns the one-row report."""
    if skip:
        return None
    r = key_report(df, keys).first()
    if r["null_key_rows"] or r["duplicate_keys"]:
        raise ValueError(f"key check failed: {r.asDict()}")
    return r.asDict()

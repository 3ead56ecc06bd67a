"""Backfill bookkeeping: pending units, gap detection, gap report (SNK16-SNK18, J10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pending(units: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SNK16: units not done yet (anti join)."""
    return units.join(done.select(*keys).distinct(), list(keys), "left_anti")


def only_known(df: DataFrame, universe: DataFrame, key: str = "ticker") -> DataFrame:
    """NRM19/J10: restrict to a symbol universe (semi join)."""
    return df.join(universe.select(key).distinct(), key, "left_semi")


def quarter_index(year: str = "year", period: str = "period"):
    """Quarter number on one axis: year * 4 + (q - 1)."""
    q = F.regexp_extract(F.col(period), r"(\d)", 1).cast("int")
    return F.col(year).cast("int") * 4 + q - 1


NO_REPORT = "no report for the quarter"


def gap_intervals(reports: DataFrame, table: str, key: str = "ticker", universe: DataFrame | None = None) -> DataFrame:
    """SNK18: runs of quarters without a report: (table_name, symbol, first_quarter, last_quarter, length, reason).

    Quarters are numbers (:func:`quarter_index`).  A gap lies between a symbol's report
    and its next one, so one window over the distinct reports finds all of them; what is
    written grows with the gaps, not with symbols times quarters.  Without ``universe`` a
    symbol is expected in its own reporting span.  With it, every symbol of the universe
    is expected in every quarter of the whole table's span: a mark one quarter before the
    span stands for each, so a symbol that never reported is one gap throughout, and
    symbols outside the universe have no mark and no gaps.
    """
    seen = reports.select(key, quarter_index().alias("qi")).where("qi is not null").distinct()
    by_key = Window.partitionBy(key)
    after = F.lead("qi").over(by_key.orderBy("qi"))
    if universe is None:
        ends = seen.withColumn("next", after)
    else:
        lo, hi = seen.select(F.min("qi")).scalar(), seen.select(F.max("qi")).scalar()
        marks = universe.select(key).distinct().select(key, (lo - 1).alias("qi")).where("qi is not null")
        both = seen.withColumn("mark", F.lit(False)).unionByName(marks.withColumn("mark", F.lit(True)))
        ends = both.withColumn("next", F.coalesce(after, hi + 1)).withColumn("expected", F.max("mark").over(by_key)).where("expected")
    return ends.where(F.col("next") - F.col("qi") > 1).select(
        F.lit(table).alias("table_name"), F.col(key).alias("symbol"), (F.col("qi") + 1).alias("first_quarter"),
        (F.col("next") - 1).alias("last_quarter"), (F.col("next") - F.col("qi") - 1).alias("length"), F.lit(NO_REPORT).alias("reason"))


def quarterly_gaps(reports: DataFrame, table: str, key: str = "ticker", universe: DataFrame | None = None) -> DataFrame:
    """SNK18: the quarters of :func:`gap_intervals` one by one."""
    quarters = F.explode(F.sequence("first_quarter", "last_quarter"))
    return gap_intervals(reports, table, key, universe).select("table_name", "symbol", "reason", quarters.alias("qi")).select(
        "table_name", "symbol", F.floor(F.col("qi") / 4).cast("int").alias("year"),
        F.concat(F.lit("Q"), (F.col("qi") % 4 + 1).cast("string")).alias("period"), "reason")


def gap_report(old: DataFrame, new: DataFrame, run_col: str = "run_id") -> DataFrame:
    """SNK17: old and new gap rows, the newest run per (table, symbol, year,
    period) kept, ordered for reading."""
    keys = ["table_name", "symbol", "year", "period"]
    u = old.unionByName(new, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.col(run_col).desc())
    return u.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn").orderBy(*keys)

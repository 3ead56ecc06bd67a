"""Training samples, chronological splits and inference windows (W25, W26, ML1-ML5, AGG8).

A sample is a trailing window of ``n`` rows of one ticker: the sequence block
(``n`` x sequence features), the tabular snapshot of the window's last row and
the last row's target.  Windows are built with ``collect_list`` over a
``ROWS (n-1) PRECEDING`` frame, so each output row is produced where its last
input row lives; nothing is gathered per ticker and nothing reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.windows import date_percent_rank

# The model's input contract.
WINDOW_SIZE = 30
TARGET = "label_next_5d_return"
SEQUENCE_FEATURES = (
    "moving_average_20d", "moving_average_50d", "price_momentum_1m", "price_momentum_3m", "volatility_30d",
    "relative_strength_vs_vnindex",
)
TABULAR_FEATURES = (
    "pe_ratio", "pb_ratio", "roe", "roa", "revenue_growth_yoy", "net_profit_growth_yoy", "gross_margin",
    "debt_to_equity", "operating_cash_flow_to_net_income", "foreign_buy_ratio_10d", "net_foreign_flow_momentum_1m",
    "prop_trading_net_val_5d", "prop_vs_foreign_correlation_10d",
)


@dataclass(frozen=True)
class FeatureSpec:
    sequence: tuple[str, ...] = SEQUENCE_FEATURES
    tabular: tuple[str, ...] = TABULAR_FEATURES
    target: str = TARGET
    window: int = WINDOW_SIZE
    key: str = "ticker"
    order: str = "trading_date"

    def __post_init__(self) -> None:
        """ML3: the lists are disjoint and never contain the target."""
        if set(self.sequence) & set(self.tabular):
            raise ValueError("sequence and tabular features overlap")
        if self.target in self.sequence or self.target in self.tabular:
            raise ValueError("target listed as a feature")


def _vec(cols: Sequence[str], fill: float | None) -> Column:
    items = [F.col(c).cast("float") for c in cols]
    if fill is not None:
        items = [F.coalesce(c, F.lit(fill).cast("float")) for c in items]
    return F.array(*items)


def sample_windows(df: DataFrame, spec: FeatureSpec = FeatureSpec(), fill: float | None = 0.0) -> DataFrame:
    """W25 / ML4: every full trailing window of rows that have a target."""
    n = spec.window
    rows = df.where(F.col(spec.target).isNotNull())
    w = Window.partitionBy(spec.key).orderBy(spec.order).rowsBetween(-(n - 1), 0)
    out = rows.select(
        spec.key, spec.order,
        F.collect_list(_vec(spec.sequence, fill)).over(w).alias("sequence"),
        _vec(spec.tabular, fill).alias("tabular"),
        F.col(spec.target).cast("float").alias("target"),
    )
    return out.where(F.size("sequence") == n)


def latest_window(df: DataFrame, spec: FeatureSpec = FeatureSpec(), fill: float | None = 0.0) -> DataFrame:
    """The newest full window per key (keys with fewer rows are skipped).
    ``fill=None`` keeps NULLs as the reference's inference path does (D21)."""
    n = spec.window
    w = Window.partitionBy(spec.key).orderBy(spec.order)
    newest = Window.partitionBy(spec.key).orderBy(F.col(spec.order).desc())
    out = df.select(
        spec.key, spec.order,
        F.collect_list(_vec(spec.sequence, fill)).over(w.rowsBetween(-(n - 1), 0)).alias("sequence"),
        _vec(spec.tabular, fill).alias("tabular"),
        F.row_number().over(newest).alias("__rn"),
    )
    return out.where((F.col("__rn") == 1) & (F.size("sequence") == n)).drop("__rn")


def time_split(df: DataFrame, train_end, val_end, date_col: str = "trading_date") -> DataFrame:
    """ML1: split column by inclusive cut dates; ``val_end`` before ``train_end`` is an error.

    Cut dates are dates, or columns such as the fields of ``cut_dates``; for columns the
    order is checked where the rows are split."""
    import datetime as dt

    d = F.col(date_col)
    if isinstance(train_end, Column):
        te, ve = train_end, val_end
        wrong = F.when(ve < te, F.raise_error(F.lit("val_end must not be before train_end")).cast("string"))
        return df.withColumn("split", F.coalesce(wrong, F.when(d <= te, "train").when(d <= ve, "val").otherwise("test")))
    te, ve = (dt.date.fromisoformat(str(x)[:10]) for x in (train_end, val_end))
    if ve < te:
        raise ValueError("val_end must not be before train_end")
    return df.withColumn(
        "split", F.when(d <= F.lit(te), "train").when(d <= F.lit(ve), "val").otherwise("test")
    )


def cut_dates(df: DataFrame, date_col: str = "trading_date", target: str = TARGET) -> Column:
    """``auto_cutoffs`` as a scalar subquery (struct train_end, val_end): no driver action while a query is built."""
    return auto_cutoffs(df, date_col, target).select(F.struct("train_end", "val_end")).scalar()


def auto_cutoffs(df: DataFrame, date_col: str = "trading_date", target: str = TARGET,
                 fracs: tuple[float, float] = (0.8, 0.9)) -> DataFrame:
    """AGG8 / ML2: one row (train_end, val_end) = newest date whose percent rank
    among labelled rows is <= 0.8 / 0.9.  Ranks come from per-date counts, so the
    only global step runs over distinct dates, never over all rows."""
    pr = date_percent_rank(df.where(F.col(target).isNotNull()), date_col)
    return pr.agg(
        F.max(F.when(F.col("pct") <= fracs[0], F.col(date_col))).alias("train_end"),
        F.max(F.when(F.col("pct") <= fracs[1], F.col(date_col))).alias("val_end"),
    )


def split_counts(samples: DataFrame) -> DataFrame:
    return samples.groupBy("split").agg(F.count(F.lit(1)).alias("n_samples"))


def require_samples(counts: DataFrame, splits: Sequence[str] = ("train", "val", "test")) -> dict[str, int]:
    """ML5: raise when a split has no samples.  ``counts`` has one row per split."""
    got = {r["split"]: int(r["n_samples"]) for r in counts.collect()}
    empty = [s for s in splits if got.get(s, 0) == 0]
    if empty:
        raise ValueError(f"no samples in split(s): {empty}")
    return got

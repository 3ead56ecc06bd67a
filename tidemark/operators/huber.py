"""Huber regression by reweighted least squares (ML6, ML8): one aggregate a round.

A round weighs every row by its residual under the last coefficients and adds up the
weighted products of its features.  Tasks add up their own rows, one shuffle adds up the
tasks, and what reaches the driver is the square of the number of features, whatever the
number of rows.  The number of rounds is fixed, so another engine can follow them.

The scale of residuals is that of a normal law whose squares, cut at the bend, have the mean
that the residuals under the coefficients before have; so outliers hardly widen it.  Rows without a target are left out; features are standardised, a constant one
has no say; a small ridge keeps equal features solvable.  Features without a value are the
caller's to fill: a NULL or NaN among them raises.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
BEND = 1.345  # residuals beyond this many scales count linearly
RIDGE = 1e-6  # of the rows
SUMS = "i int, j int, s double"


def cut_square(bend: float) -> float:
    """Mean of min(z, bend) squared for a standard normal z."""
    inside = math.erf(bend / math.sqrt(2))
    return inside - 2 * bend * math.exp(-bend * bend / 2) / math.sqrt(2 * math.pi) + bend * bend * (1 - inside)


@dataclass(frozen=True)
class HuberModel:
    coefficients: list[float]
    intercept: float
    scale: float
    rows: int

    def predict(self, features: str | Column) -> Column:
        """The prediction for an array of features, as a column expression."""
        weights = F.array(*[F.lit(c) for c in self.coefficients])
        parts = F.zip_with(F.col(features) if isinstance(features, str) else features, weights, lambda x, c: x.cast("double") * c)
        return F.aggregate(parts, F.lit(self.intercept), lambda total, part: total + part)


def _round(rows: DataFrame, mean: np.ndarray, spread: np.ndarray, b: np.ndarray, bend: float) -> tuple[np.ndarray, float, int]:
    """Weighted products of (1, features) with (1, features, target), the sum of squared residuals cut at the bend, and the rows."""
    p = len(mean) + 1

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size, n = np.zeros((p, p + 1)), 0.0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, p - 1)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            if not np.isfinite(x).all():
                raise ValueError("a feature is NULL or not finite")
            z = np.concatenate([np.ones((len(y), 1)), (x - mean) / spread, y[:, None]], axis=1)
            r = np.abs(y - z[:, :p] @ b)
            cut = np.minimum(r, bend)
            w = np.divide(cut, r, out=np.ones(len(y)), where=r > bend)
            total += (z[:, :p] * w[:, None]).T @ z
            size, n = size + float(cut @ cut), n + len(y)
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array([*i.ravel(), p, p], pa.int32()), pa.array([*j.ravel(), 0, 1], pa.int32()),
                                          pa.array([*total.ravel(), size, float(n)])], names=["i", "j", "s"])

    got = {(r["i"], r["j"]): r["s"] for r in rows.mapInArrow(add, SUMS).groupBy("i", "j").agg(F.sum("s").alias("s")).collect()}
    return np.array([[got[i, j] for j in range(p + 1)] for i in range(p)]), got[p, 0], int(got[p, 1])


def fit_huber(df: DataFrame, features: str, target: str, rounds: int = ROUNDS, bend: float = BEND, ridge: float = RIDGE) -> HuberModel:
    """Fit on an array column of features.  ``df`` is read ``rounds + 2`` times: give a written or checkpointed table.

    Without a row that has a target ValueError is raised."""
    rows = df.where(F.col(target).isNotNull()).select(F.col(features).cast("array<double>").alias("x"), F.col(target).cast("double").alias("y"))
    stats = (rows.select(F.posexplode("x").alias("j", "v")).groupBy("j")
             .agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("spread")).orderBy("j").collect())  # one row a feature
    if not stats:
        raise ValueError("no rows with a target")
    mean = np.array([r["mean"] for r in stats], float)
    spread = np.array([r["spread"] or math.inf for r in stats], float)
    b, limit, scale, n = np.zeros(len(mean) + 1), math.inf, 0.0, 0
    for _ in range(rounds + 1):  # the first is least squares
        sums, size, n = _round(rows, mean, spread, b, limit)
        b = np.linalg.solve(sums[:, :-1] + ridge * n * np.eye(len(b)), sums[:, -1])
        scale = math.sqrt(size / n / (cut_square(bend) if math.isfinite(limit) else 1))
        limit = bend * scale
    raw = b[1:] / spread
    return HuberModel([float(c) for c in raw], float(b[0] - raw @ mean), scale, n)

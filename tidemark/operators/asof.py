"""Backward as-of join (J3) without a nested-loop join.

``merge_asof(direction="backward")`` semantics: each left row gets the right
row with the greatest ``right_on <= left_on`` inside the same ``by`` group.

Plan: both sides are unioned into one stream, sorted once per ``by`` group by
``(time, side)`` with right rows first on equal times (so equality matches),
and the latest right payload is carried forward with
``last(payload, ignorenulls=True)`` over an unbounded-preceding frame.  The
payload is a struct, so a matched row whose own values are NULL is still a
match (a NULL *struct* is only produced by left rows).  Cost: one shuffle on
``by`` + one sort; no pairwise comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SIDE, _T, _PAYLOAD, _MATCH = "__asof_side", "__asof_t", "__asof_payload", "__asof_match"


def dedupe_right(right: DataFrame, by: Sequence[str], on: str, order: Sequence | None = None) -> DataFrame:
    """Keep one right row per (by, on) (AGG13); ``order`` decides which (first kept)."""
    from tidemark.operators.dedupe import latest_by

    return latest_by(right, list(by) + [on], list(order) if order else [F.col(on)])


def asof_backward(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str,
                  columns: Sequence[str]) -> DataFrame:
    by = list(by)
    left_cols = left.columns
    lt = left.select(*left_cols, F.col(left_on).alias(_T), F.lit(1).alias(_SIDE))
    rt = right.select(
        *[F.col(b) for b in by],
        F.col(right_on).alias(_T),
        F.lit(0).alias(_SIDE),
        F.struct(*[F.col(c) for c in columns]).alias(_PAYLOAD),
    )
    u = lt.unionByName(rt, allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(_T, _SIDE).rowsBetween(Window.unboundedPreceding, 0)
    carried = u.withColumn(_MATCH, F.last(_PAYLOAD, ignorenulls=True).over(w))
    out = carried.where(F.col(_SIDE) == 1)
    return out.select(*left_cols, *[F.col(f"{_MATCH}.{c}").alias(c) for c in columns])

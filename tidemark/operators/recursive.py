"""Recursive series features as an associative scan (W11: EMA / MACD).

``e_t = (1 - a) * e_{t-1} + a * x_t`` with ``a = 2 / (span + 1)`` and the first value
as seed (pandas ``ewm(span, adjust=False)``).  A step is an affine map of the value
before it, and affine maps compose: a block of up to BLOCK rows is one map
``e -> keep^n * e + c`` (and, without a value before it, the value it ends with).  A
series is grouped into blocks, the maps of the blocks before each one are composed over
the (short) list of a key's blocks, and each block is then worked through from what
comes into it.  All of it is DataFrame expressions: no Python, no join back, and the
grouping and the window both keep a partitioning by key that the input already has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 64  # rows a block has at most


def ema_alpha(span: int) -> tuple[float, float]:
    a = 2.0 / (span + 1.0)
    return a, 1.0 - a


def _step(e: Column, x: Column, span: int) -> Column:
    """The value after ``x``: the seed if there is none before, the same if ``x`` is missing."""
    a, keep = ema_alpha(span)
    return F.when(x.isNull(), e).when(e.isNull(), x).otherwise(F.lit(keep) * e + F.lit(a) * x)


def _block_map(x: Column, span: int) -> Column:
    """What a block does to the value before it: (factor, shift, value without one before)."""
    a, keep = ema_alpha(span)
    there = F.filter(x, lambda v: v.isNotNull())
    return F.struct(
        F.pow(F.lit(keep), F.size(there).cast("double")).alias("factor"),
        F.aggregate(there, F.lit(0.0), lambda e, v: F.lit(keep) * e + F.lit(a) * v).alias("shift"),
        F.aggregate(there, F.lit(None).cast("double"), lambda e, v: _step(e, v, span)).alias("alone"))


def _composed(maps: Column) -> Column:
    return F.aggregate(maps, F.lit(None).cast("double"),
                       lambda e, m: F.when(e.isNull(), m["alone"]).otherwise(m["factor"] * e + m["shift"]))


def ema_features(df: DataFrame, key: str, order: str, value: str, spans: Sequence[int] = (12, 26),
                 macd: tuple[int, int] | None = (12, 26), keep: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """(key, order, value, kept columns) with ``ema_<span>`` (and ``macd = ema_fast - ema_slow``) per key.

    A NaN counts as missing; values before a key's first one are NULL.
    """
    spans = list(dict.fromkeys(spans))
    number = F.row_number().over(Window.partitionBy(key).orderBy(order))
    x = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    rows = df.select(key, F.floor((number - 1) / block).alias("__block"),
                     F.struct(F.col(order).alias("__at"), F.col(value).alias("__value"), x.alias("__x"), *keep).alias("__row"))
    blocks = rows.groupBy(key, "__block").agg(F.sort_array(F.collect_list("__row")).alias("__rows"))  # at most ``block`` rows
    before = Window.partitionBy(key).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("*", *[_block_map(F.col("__rows.__x"), s).alias(f"__map_{s}") for s in spans])
    blocks = blocks.select(key, "__rows", *[_composed(F.collect_list(f"__map_{s}").over(before)).alias(f"__in_{s}") for s in spans])

    def within(span: int) -> Column:
        """The values after each row of a block."""
        start = F.struct(F.col(f"__in_{span}").alias("e"), F.array().cast("array<double>").alias("all"))

        def grown(acc: Column, v: Column) -> Column:
            e = _step(acc["e"], v, span)
            return F.struct(e.alias("e"), F.concat(acc["all"], F.array(e)).alias("all"))

        return F.aggregate(F.col("__rows.__x"), start, grown, lambda acc: acc["all"])

    out = blocks.select(key, F.explode(F.arrays_zip(F.col("__rows"), *[within(s).alias(f"ema_{s}") for s in spans])).alias("z"))
    out = out.select(key, F.col("z.__rows.__at").alias(order), F.col("z.__rows.__value").alias(value),
                     *[F.col(f"z.__rows.{c}") for c in keep], *[F.col(f"z.ema_{s}") for s in spans])
    return out.withColumn("macd", F.col(f"ema_{macd[0]}") - F.col(f"ema_{macd[1]}")) if macd else out

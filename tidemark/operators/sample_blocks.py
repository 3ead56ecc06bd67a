"""Training windows stored as blocks of rows (W25, ML4, SNK15).

Windows of 30 rows that move by one repeat every row 30 times.  A block holds ``length``
consecutive rows of one key, once, and before them the last ``window - 1`` rows of the block
before; a sample is a (block, offset) pair.  Written size is 1 + (window - 1) / length times
the rows, and a long series becomes many blocks that are read apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.samples import FeatureSpec, _vec

BLOCK = 512  # rows of a block


def sample_blocks(df: DataFrame, spec: FeatureSpec = FeatureSpec(), fill: float | None = 0.0, length: int = BLOCK) -> DataFrame:
    """Rows that have a target as blocks: (key, block, lead, sequence, order, tabular, target).

    ``sequence`` holds ``lead`` rows of the block before, then the block's own; the other lists hold own rows only."""
    lap = spec.window - 1
    if length < max(lap, 1):
        raise ValueError(f"blocks of {length} rows are shorter than the overlap of {lap}")
    place = F.row_number().over(Window.partitionBy(spec.key).orderBy(spec.order)) - 1
    own = F.floor(F.col("__place") / length)
    rows = df.where(F.col(spec.target).isNotNull()).select(
        spec.key, place.alias("__place"), F.col(spec.order).alias("__order"), _vec(spec.sequence, fill).alias("__sequence"),
        _vec(spec.tabular, fill).alias("__tabular"), F.col(spec.target).cast("float").alias("__target"))
    blocks = F.when(F.col("__place") % length >= length - lap, F.array(own, own + 1)).otherwise(F.array(own))
    row = F.struct(F.col("__place").alias("place"), F.col("__order").alias("order"), F.col("__sequence").alias("sequence"),
                   F.col("__tabular").alias("tabular"), F.col("__target").alias("target"))
    held = (rows.select("*", F.explode(blocks).alias("block")).groupBy(spec.key, "block")
            .agg(F.array_sort(F.collect_list(row)).alias("rows")))
    lead = F.size(F.filter("rows", lambda r: r["place"] < F.col("block") * length))
    held = held.withColumn("lead", lead).where(F.size("rows") > F.col("lead"))
    mine = F.slice("rows", F.col("lead") + 1, F.size("rows"))
    return held.select(spec.key, "block", "lead", F.transform("rows", lambda r: r["sequence"]).alias("sequence"),
                       F.transform(mine, lambda r: r["order"]).alias(spec.order), F.transform(mine, lambda r: r["tabular"]).alias("tabular"),
                       F.transform(mine, lambda r: r["target"]).alias("target"))


def block_windows(blocks: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """Every full window of the blocks, as ``sample_windows`` gives them; no shuffle."""
    n = spec.window
    rows = blocks.select(spec.key, "lead", "sequence", F.posexplode(F.arrays_zip(spec.order, "tabular", "target")).alias("__at", "__row"))
    end = F.col("lead") + F.col("__at") + 1
    return rows.where(end >= n).select(
        spec.key, F.col(f"__row.{spec.order}").alias(spec.order), F.slice("sequence", end - n + 1, n).alias("sequence"),
        F.col("__row.tabular").alias("tabular"), F.col("__row.target").alias("target"))

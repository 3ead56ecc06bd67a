"""Row numbers within each source file (W23, SNK5), without a global sort.

Parquet scans know the place of a row in its file.  For other sources a first pass counts
the rows of each split of a file; sums of those counts are the splits' offsets, and rows
are then numbered inside their split, which is never larger than the scan's split size.
Splits and rows keep the order of the file, so numbers are free of gaps and the same on
every run, however the scan deals out splits to tasks.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import small_side


def _scan_fields(df: DataFrame) -> list[str]:
    """What the file source under ``df`` tells about a row; nothing where there is none."""
    try:
        return df.select("_metadata").schema["_metadata"].dataType.names
    except AnalysisException:
        return []


def number_rows(df: DataFrame, number: str = "src_row", file: str = "src_file") -> DataFrame:
    """``df``, straight from a file source, with each row's file and its number there, from 0.

    Rows that a filter on a text, CSV or JSON scan dropped are not counted; on Parquet they keep
    their numbers.  Rows of no file raise ValueError."""
    fields = _scan_fields(df)
    if "file_path" not in fields:
        raise ValueError("rows do not come straight from a file source")
    path = F.col("_metadata.file_path").alias(file)
    if "row_index" in fields:
        return df.select("*", path, F.col("_metadata.row_index").alias(number))
    start = F.col("_metadata.file_block_start").alias("__start")
    split = Window.partitionBy(file, "__start").orderBy("__id")
    before = Window.partitionBy(file).orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.select(path, start).groupBy(file, "__start").agg(F.count("*").alias("__n"))
    offsets = counts.select(file, "__start", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    rows = df.select("*", path, start, F.monotonically_increasing_id().alias("__id")).withColumn("__own", F.row_number().over(split) - 1)
    return (rows.join(small_side(offsets), [file, "__start"])
            .select(*[F.col(f"`{c}`") for c in df.columns], file, (F.col("__before") + F.col("__own")).alias(number)))

"""Landing-file pre-processing (CLN1-CLN6): NUL stripping, bad-line removal,
archive expansion, dispatch and stage-key extraction.

Files are read as lines by Spark's own source, or as streams by the sources of
``archives.py``, so each file's work runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.archives import CHUNK, archive_chunks, encoded_lines

BAD_LINE = "invalid formula"
NUL = "\u0000"


def read_lines(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8") -> DataFrame:
    """Lines of text files, blank ones too, keeping ``\\r`` (only ``\\n`` splits lines), with the
    source file and a line id that ascends in each file.  Other encodings (CLN2) are decoded as
    streams in the tasks that open the files; 'UTF-16' takes the byte order from each file's
    mark (little-endian without one)."""
    if encoding.upper().replace("_", "").replace("-", "") != "UTF8":
        return encoded_lines(spark, path, encoding)
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    return lines.withColumn("line_no", F.monotonically_increasing_id())


def strip_nul(lines: DataFrame, col: str = "value") -> DataFrame:
    """CLN1/CLN2: remove NUL characters, keep everything else (incl. ``\\r``)."""
    return lines.withColumn(col, F.regexp_replace(F.col(col), NUL, ""))


def drop_lines(lines: DataFrame, needle: str = BAD_LINE, col: str = "value") -> DataFrame:
    """CLN3: drop lines containing ``needle``."""
    return lines.where(~F.col(col).contains(needle))


def expand_archives(spark: SparkSession, path: str | list[str], chunk: int = CHUNK) -> DataFrame:
    """CLN4: members of zip / tar / gz files, whatever the case of the suffix, as (archive, member, place, chunk,
    content) rows of at most ``chunk`` bytes, read as streams; members whose path would escape the stage are skipped."""
    return archive_chunks(spark, path, chunk)


def whole_members(chunks: DataFrame) -> DataFrame:
    """Chunks put together again, one row a member: only for members known to fit a row."""
    parts = F.array_sort(F.collect_list(F.struct("chunk", "content")))
    body = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["content"]))
    return chunks.groupBy("archive", "member", "place").agg(body.alias("content"))


PREPROCESSORS = ("none", "strip_nul", "strip_nul_utf16", "drop_invalid_formula", "unarchive")


def preprocess(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """CLN5: dispatch by pre-processing type; unknown types raise."""
    if kind not in PREPROCESSORS:
        raise ValueError(f"unknown preprocess type {kind!r}")
    if kind == "unarchive":
        return expand_archives(spark, path)
    if kind == "strip_nul_utf16":
        return strip_nul(read_lines(spark, path, "UTF-16"))
    lines = read_lines(spark, path)
    if kind == "strip_nul":
        return strip_nul(lines)
    if kind == "drop_invalid_formula":
        return drop_lines(lines)
    return lines


# Stage key: <table>/batch_date=<d>/<10-digit unix ts>/<file>; legacy keys lack the ts.
STAGE_KEY = r"([^/]+)/batch_date=(\d{4}-\d{2}-\d{2})/(\d{10})/[^/]+$"
LEGACY_KEY = r"([^/]+)/batch_date=(\d{4}-\d{2}-\d{2})/[^/]+$"


def stage_key(df: DataFrame, path_col: str | Column = "file", mtime_col: str | Column | None = None) -> DataFrame:
    """CLN6: (table, batch_date, load_ts) from the landing path; for legacy
    paths without the timestamp segment the file's modification time is used."""
    p = F.col(path_col) if isinstance(path_col, str) else path_col
    mt = (F.col(mtime_col) if isinstance(mtime_col, str) else mtime_col) if mtime_col is not None else F.lit(None)
    new_ts = F.regexp_extract(p, STAGE_KEY, 3)
    is_new = new_ts != ""
    table = F.when(is_new, F.regexp_extract(p, STAGE_KEY, 1)).otherwise(F.nullif(F.regexp_extract(p, LEGACY_KEY, 1),
                                                                                 F.lit("")))
    bdate = F.when(is_new, F.regexp_extract(p, STAGE_KEY, 2)).otherwise(F.nullif(F.regexp_extract(p, LEGACY_KEY, 2),
                                                                                 F.lit("")))
    ts = F.when(is_new, new_ts.cast("bigint")).otherwise(F.unix_timestamp(mt.cast("timestamp")))
    return df.select("*", table.alias("stage_table"), bdate.cast("date").alias("stage_batch_date"),
                     ts.alias("stage_ts"))

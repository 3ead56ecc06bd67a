"""Landing-file readers and slices (SRC1-SRC11).

Readers always take an explicit schema (no inference).  Slices are plain
filters, so Catalyst pushes them into the Parquet scan / partition pruning.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.csv_files import read_csv_files

FORMATS = ("parquet", "json", "csv")


def _check_url(path: str) -> None:
    """SRC4: only store / file paths are loadable."""
    if "://" in path and not path.split("://", 1)[0] in ("s3", "s3a", "gs", "abfs", "abfss", "hdfs", "file"):
        raise ValueError(f"not a storage path: {path}")


def read_bronze(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    """SRC1-SRC4: bulk-load a landing prefix in one of the supported formats."""
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}; expected one of {FORMATS}")
    _check_url(path)
    r = spark.read.schema(schema)
    if fmt == "parquet":
        return r.parquet(path)
    if fmt == "json":
        # JSON lines; field names match case-insensitively (the JSON parser itself
        # is case-sensitive), so each record is parsed as a lower-cased text map
        lines = spark.read.text(path)
        rec = F.transform_keys(F.from_json("value", "map<string,string>", {"mode": "PERMISSIVE"}),
                               lambda k, v: F.lower(k))
        return lines.select(*[rec[f.name.lower()].cast(f.dataType).alias(f.name) for f in schema.fields])
    return r.option("header", True).option("mode", "PERMISSIVE").csv(path)


def _no_files(e: Exception) -> bool:
    return any(k in str(e) for k in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"))


def _by_name(parts: list[DataFrame]) -> DataFrame | None:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p, allowMissingColumns=True)
    return out


def read_csv_folder(spark: SparkSession, folder: str, schema: T.StructType | None = None, malformed: str = "drop") -> DataFrame | None:
    """SRC6: every ``*.csv`` of a folder as one frame, columns matched by name; None when there are none."""
    out = read_csv_files(spark, folder, malformed=malformed)
    if out is None or schema is None:
        return out
    return out.select(*[(F.col(f"`{f.name}`") if f.name in out.columns else F.lit(None).cast("string")).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_mixed_folder(spark: SparkSession, folder: str) -> DataFrame | None:
    """SRC7: CSV and Parquet files of one folder, all columns as text and matched by
    name, CSV records with too many fields dropped, hidden / unsupported files ignored.
    None when the folder holds neither; any other read error is raised."""
    parts = [p for p in [read_csv_files(spark, folder)] if p is not None]
    try:
        pq = spark.read.option("pathGlobFilter", "[!._]*.parquet").option("mergeSchema", True).parquet(folder)
        parts.append(pq.select([F.col(c).cast("string") for c in pq.columns]))
    except Exception as e:  # noqa: BLE001
        if not _no_files(e):
            raise
    return _by_name(parts)


def read_training_set(spark: SparkSession, path: str) -> DataFrame:
    """SRC8: all Parquet parts of an export; an export with no rows is an error."""
    df = spark.read.parquet(path)
    if df.isEmpty():
        raise ValueError(f"no training rows under {path}")
    return df


def latest_slice(df: DataFrame, date_col: str, dates: DataFrame | None = None) -> DataFrame:
    """SRC9: rows of the newest date (``WHERE d = (SELECT MAX(d))``), as a scalar
    subquery: one small aggregate, then a filter on the scan.  ``dates``: a cheaper
    frame with the same newest date, as the price rows of a wide table."""
    newest = (df if dates is None else dates).select(F.max(date_col)).scalar()
    return df.where(F.col(date_col) == newest)


def lookback_slice(df: DataFrame, date_col: str, anchor: dt.date | str | None = None, days: int = 90,
                   dates: DataFrame | None = None) -> DataFrame:
    """SRC10: rows in ``(anchor - days, anchor]``; anchor defaults to the newest date (of ``dates``, if given)."""
    a = F.lit(str(anchor)).cast("date") if anchor is not None else (df if dates is None else dates).select(F.max(date_col)).scalar()
    return df.where((F.col(date_col) <= a) & (F.col(date_col) > F.date_sub(a, days)))


def months_back(df: DataFrame, date_col: str, months: int | None = None,
                as_of: dt.date | str | None = None) -> DataFrame:
    """SRC11: ``d >= add_months(as_of, -n)``; no filter when ``months`` is None."""
    if months is None:
        return df
    base = F.lit(str(as_of)).cast("date") if as_of else F.current_date()
    return df.where(F.col(date_col) >= F.add_months(base, -months))

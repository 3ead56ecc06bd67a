"""CSV folders as a Spark data source whose partitions are files (SRC6, SRC7).

Every file has a header of its own, in any order of columns.  A task opens its files
and parses them as streams, so a quoted field may hold separators, quotes and line
ends, and nothing larger than a batch of records is held.  Headers are read by a scan
that stops after each file's first record; the number of distinct column names is all
that reaches the driver.  Files are then read once, as text columns matched by name.

A record with fewer fields than its file's header has NULLs, one with more is malformed;
empty lines are skipped; an empty field without quotes is NULL.
"""

from __future__ import annotations

import csv
import fnmatch
import io
import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.session import ship_package

NAME = "tidemark_csv"
TASK_BYTES = 64_000_000  # small files share a task
BATCH = 2_000  # records of an Arrow batch
EXTRA, FILE = "__extra", "__file"


@dataclass
class Files(InputPartition):
    paths: list[str]


def _store(uri: str):
    from pyarrow import fs

    if "://" not in uri:
        uri = "file://" + (uri[5:] if uri.startswith("file:") else uri)
    return fs.FileSystem.from_uri(uri)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.pattern = options["path"], options.get("pattern", "*.csv")
        self.columns = json.loads(options["columns"]) if "columns" in options else None

    def partitions(self) -> list[Files]:
        from pyarrow import fs

        store, base = _store(self.folder)
        found = sorted((f for f in store.get_file_info(fs.FileSelector(base, allow_not_found=True))
                        if f.type == fs.FileType.File and f.base_name[:1] not in "._" and fnmatch.fnmatch(f.base_name, self.pattern)),
                       key=lambda f: f.path)
        out, size = [], TASK_BYTES
        for f in found:
            if size + f.size > TASK_BYTES:
                out.append(Files([]))
                size = 0
            out[-1].paths.append(f.path)
            size += f.size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        store, _ = _store(self.folder)
        for path in partition.paths:
            with store.open_input_stream(path) as raw:
                text = io.TextIOWrapper(io.BufferedReader(raw), encoding="utf-8-sig", errors="replace", newline="")
                records = (r for r in csv.reader(text, quoting=csv.QUOTE_NOTNULL) if r)
                header = [name.strip() if name else "" for name in next(records, [])]
                if self.columns is None:
                    names = [n for n in header if n]
                    if names:
                        yield pa.RecordBatch.from_pydict({"file": pa.array([path] * len(names)), "place": pa.array(range(len(names)), pa.int32()), "name": pa.array(names, pa.string())})
                elif header:
                    yield from self._rows(path, header, records)

    def _rows(self, path: str, header: list[str], records: Iterator[list]) -> Iterator[pa.RecordBatch]:
        place = {name: i for i, name in reversed(list(enumerate(header)))}
        while held := [r for _, r in zip(range(BATCH), records)]:
            extra = pa.array([len(r) > len(header) for r in held])
            columns = [pa.array([r[i] if i < len(r) else None for r in held], pa.string()) if (i := place.get(c)) is not None
                       else pa.nulls(len(held), pa.string()) for c in self.columns]
            yield pa.RecordBatch.from_arrays([*columns, extra, pa.array([path] * len(held))], names=[*self.columns, EXTRA, FILE])


class CsvFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        if "columns" not in self.options:
            return "file string, place int, name string"
        quoted = (c.replace("`", "``") for c in json.loads(self.options["columns"]))
        return ", ".join([*(f"`{c}` string" for c in quoted), f"{EXTRA} boolean", f"{FILE} string"])

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def read_csv_files(spark: SparkSession, folder: str, pattern: str = "*.csv", malformed: str = "drop") -> DataFrame | None:
    """All CSV files of a folder as text columns, matched by name, in the order they first appear; None without files.

    ``malformed``: records with more fields than their header are dropped, or make the read ``fail``.
    """
    if malformed not in ("drop", "fail"):
        raise ValueError(f"malformed must be 'drop' or 'fail', not {malformed!r}")
    ship_package(spark)
    spark.dataSource.register(CsvFiles)
    source = lambda: spark.read.format(NAME).option("pattern", pattern)
    heads = source().load(folder)
    names = [r["name"] for r in heads.groupBy("name").agg(F.min(F.struct("file", "place")).alias("at")).orderBy("at").collect()]
    if not names:
        return None
    rows = source().option("columns", json.dumps(names)).load(folder)
    if malformed == "fail":
        bad = F.raise_error(F.concat(F.lit("more fields than the header in "), F.col(FILE)))
        rows = rows.withColumn(EXTRA, F.when(F.col(EXTRA), bad.cast("boolean")).otherwise(F.col(EXTRA)))
    return rows.where(~F.col(EXTRA)).select(*names)

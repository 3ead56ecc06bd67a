"""Archives and encoded text as Spark data sources whose partitions are files (CLN2, CLN4).

A task opens its files and reads them as streams: members of an archive come out as
chunks of at most ``CHUNK`` bytes, lines of an encoded file as they are decoded.  No
file, no archive and no member is ever held whole, so their sizes have no limit; a
line of text is the largest thing in memory besides one batch.

A member without bytes has one empty chunk.  Members of the same name are told apart by
their place in the archive.  Members whose path would leave the stage are skipped.
Encoded files lose their byte order mark; an empty file has no lines; text that the
encoding does not allow fails the read.
"""

from __future__ import annotations

import codecs
import fnmatch
import gzip
import json
import posixpath
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader

from tidemark.session import ship_package
from tidemark.sources.csv_files import TASK_BYTES, Files, _store

CHUNK = 4 << 20  # bytes of a chunk, and of what is read at a time
ZIP, TAR, GZIP = (".zip",), (".tar", ".tar.gz", ".tgz"), (".gz",)
CHUNKS = pa.schema([("archive", pa.string()), ("member", pa.string()), ("place", pa.int32()), ("chunk", pa.int32()), ("content", pa.binary())])
LINES = pa.schema([("file", pa.string()), ("value", pa.string()), ("line_no", pa.int64())])


def _listed(path: str) -> list:
    """Files at a path: the file itself, those of a folder, or those that a pattern in the last part names."""
    from pyarrow import fs

    store, base = _store(path)
    pattern = "*"
    info = store.get_file_info(base)
    if info.type == fs.FileType.File:
        return [info]
    if info.type == fs.FileType.NotFound:
        base, pattern = posixpath.split(base)
        if not set(pattern) & set("*?["):
            raise FileNotFoundError(path)
    return sorted((f for f in store.get_file_info(fs.FileSelector(base))
                   if f.type == fs.FileType.File and f.base_name[:1] not in "._" and fnmatch.fnmatch(f.base_name, pattern)), key=lambda f: f.path)


class _FileTasks(DataSourceReader):
    suffixes: tuple[str, ...] = ("",)

    def __init__(self, options: dict):
        self.folders, self.options = json.loads(options["paths"]), options

    def partitions(self) -> list[Files]:
        """Small files share a task."""
        out, size, folder = [], TASK_BYTES, None
        for folder in self.folders:
            for f in _listed(folder):
                if not f.path.lower().endswith(self.suffixes):
                    continue
                if size + f.size > TASK_BYTES:
                    out.append(Files([]))
                    size = 0
                out[-1].paths.append(f.path)
                size += f.size
        return out or [Files([])]


def is_safe(name: str) -> bool:
    """Whether a member's path stays inside the folder it is unpacked to."""
    norm = posixpath.normpath(name)
    return not (norm.startswith("/") or norm == ".." or norm.startswith("../"))


def _members(path: str, store) -> Iterator[tuple[str, object]]:
    """(name, stream) of an archive's files in their order; a stream ends before the next one starts."""
    name = path.lower()
    if name.endswith(ZIP):
        with store.open_input_file(path) as raw, zipfile.ZipFile(raw) as z:  # the directory is at the end
            for info in z.infolist():
                if not info.is_dir():
                    with z.open(info) as stream:
                        yield info.filename, stream
        return
    with store.open_input_stream(path, compression=None) as raw:
        if name.endswith(TAR):
            with tarfile.open(fileobj=raw, mode="r|*") as t:
                for m in t:
                    if m.isfile():
                        yield m.name, t.extractfile(m)
                    t.members = []  # else the headers of all members so far are kept
        else:
            with gzip.GzipFile(fileobj=raw) as stream:
                yield posixpath.basename(path)[: -len(".gz")], stream


class _ArchiveReader(_FileTasks):
    suffixes = ZIP + TAR + GZIP

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.folders[0])
        limit = int(self.options["chunk"])
        held, size = [], 0
        for path in partition.paths:
            for place, (member, stream) in enumerate(_members(path, store)):
                if not is_safe(member):
                    continue
                chunk = 0
                while (content := stream.read(limit)) or not chunk:
                    held.append((path, member, place, chunk, content))
                    chunk, size = chunk + 1, size + len(content)
                    if size >= limit or len(held) >= 1000:
                        yield self._batch(held)
                        held, size = [], 0
        if held:
            yield self._batch(held)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), CHUNKS)], schema=CHUNKS)


class _LineReader(_FileTasks):
    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.folders[0])
        for path in partition.paths:
            number = 0
            with store.open_input_stream(path, compression=None) as raw:
                for lines in _decoded(raw, self.options["encoding"]):
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(lines)), pa.array(lines, pa.string()),
                                                      pa.array(range(number, number + len(lines)), pa.int64())], schema=LINES)
                    number += len(lines)


def _decoded(raw, encoding: str, limit: int = CHUNK) -> Iterator[list[str]]:
    """Lines of a byte stream, split at line feeds only; lists of them as they are complete."""
    decoder, rest, first = codecs.getincrementaldecoder(encoding)(), [], True
    while True:
        data = raw.read(limit)
        text = decoder.decode(data, final=not data)
        if first and text:
            text, first = text.removeprefix("\ufeff"), False
        *lines, last = text.split("\n")
        if lines:
            lines[0] = "".join([*rest, lines[0]])
            rest = []
            yield lines
        if last:
            rest.append(last)
        if not data:
            if rest:
                yield ["".join(rest)]
            return


class ArchiveChunks(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_archive"

    def schema(self) -> str:
        return "archive string, member string, place int, chunk int, content binary"

    def reader(self, schema) -> DataSourceReader:
        return _ArchiveReader(dict(self.options))


class EncodedLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_lines"

    def schema(self) -> str:
        return "file string, value string, line_no bigint"

    def reader(self, schema) -> DataSourceReader:
        return _LineReader(dict(self.options))


def _load(spark: SparkSession, source: type[DataSource], path: str | list[str], **options) -> DataFrame:
    ship_package(spark)
    spark.dataSource.register(source)
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format(source.name()).options(paths=json.dumps(paths), **options).load()


def archive_chunks(spark: SparkSession, path: str | list[str], chunk: int = CHUNK) -> DataFrame:
    """Members of the zip, tar and gzip files at a path as (archive, member, place, chunk, content) rows."""
    return _load(spark, ArchiveChunks, path, chunk=str(chunk))


def encoded_lines(spark: SparkSession, path: str | list[str], encoding: str) -> DataFrame:
    """Lines of text files in any encoding that Python knows, as (file, value, line_no); lines count from 0 in each file."""
    codecs.lookup(encoding)
    return _load(spark, EncodedLines, path, encoding=encoding)

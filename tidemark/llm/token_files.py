"""Token ids in patched frame-of-reference files (operator 7).

``write_ids`` sorts documents by id over range partitions, encodes each text
with the tokenizers library, appends the end id, and every task writes shards
of whole documents into a folder on shared storage.  ``read_ids`` reads the
shards back through Spark's own file source.

Shard file (little-endian):
  magic ``TDPF``, u32 version, u64 documents, u64 ids, u64 blocks, u32 block size
  document table: i64 id, u8 id is null, u64 number of ids, one array each
  block table: u32 minimum, u8 width, u16 exceptions, u64 first byte of the block
  blocks: values minus the block's minimum, the low ``width`` bits packed; then
  u16 positions and u32 high parts of the values that need more bits.
A block's width is the bit length that one of PERCENTILES of its values fit in:
the one that makes the block smallest.  A few large ids become exceptions and
don't widen the block.  The block table makes any id reachable without unpacking
what lies before it.

A task writes under a name of its own attempt and renames it, so a lost or
repeated task leaves one whole shard.  Null and empty texts hold just the end
id; repeated ids stay separate documents, ordered by id, then place in the input; a null
id sorts first; other columns are not read; an empty table writes no shard.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shared_folder, slices
from tidemark.llm.word_encoder import ChunkEncoder, load
from tidemark.session import BROADCAST_LIMIT_BYTES

BLOCK = 1024
PERCENTILES = (0.5, 0.75, 0.9, 0.97, 1.0)
SHARD_IDS = 2_000_000
MAGIC = b"TDPF\x01\x00\x00\x00"


@lru_cache(1)
def _encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(load(path), 1_000_000, special_as_text=False)


_BITS = np.array([v.bit_length() for v in range(1 << 16)], np.uint8)


def _bit_length(values: np.ndarray) -> np.ndarray:
    high = (values >> 16).astype(np.uint16)
    out = _BITS[values & 0xFFFF]
    return np.where(high > 0, _BITS[high] + 16, out).astype(np.uint8) if high.any() else out


def pack(ids: np.ndarray, percentiles: tuple[float, ...] = PERCENTILES) -> tuple[np.ndarray, ...]:
    """(minimum, width, exceptions, first byte, packed bytes) of all blocks."""
    n = -(-len(ids) // BLOCK)
    padded = np.concatenate([ids, np.repeat(ids[-1:], n * BLOCK - len(ids))]).reshape(n, BLOCK)
    parts = [_pack_blocks(padded[i : i + 256], percentiles) for i in range(0, n, 256)]  # a few blocks fit the cache
    low, width, exceptions = (np.concatenate([p[k] for p in parts]) for k in range(3))
    bodies = [b for p in parts for b in p[3]]
    first = np.concatenate([[0], np.cumsum([len(b) for b in bodies])[:-1]]).astype("<u8")
    return low.astype("<u4"), width, exceptions.astype("<u2"), first, b"".join(bodies)


def _pack_blocks(values: np.ndarray, percentiles: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    n = len(values)
    low = values.min(axis=1)
    rest = (values - low[:, None]).astype("<u4")
    bits = _bit_length(rest)
    # how many values of each block need more than 0, 1, .. bits
    longer = np.stack([(bits > w).sum(axis=1) for w in range(int(bits.max()) + 1)])
    allowed = [BLOCK - 1 - min(BLOCK - 1, int(p * BLOCK)) for p in percentiles]
    options = np.stack([(longer <= a).argmax(axis=0) for a in allowed])
    rows = np.arange(n)
    best = (BLOCK * options // 8 + 6 * longer[options, rows]).argmin(axis=0)
    width = options[best, rows].astype(np.uint8)
    exceptions = longer[width, rows].astype(np.uint16)
    bodies: list[bytes] = [b""] * n
    for w in np.unique(width).tolist():
        own = np.flatnonzero(width == w)
        kind, size = ("<u2", 16) if w <= 16 else ("<u4", 32)
        narrow = rest[own].astype(kind)
        if w != 16:
            planes = np.unpackbits(narrow.view(np.uint8), axis=1, bitorder="little")
            planes = planes.reshape(len(own), BLOCK, size)[:, :, :w].reshape(len(own), -1)
            narrow = np.packbits(planes, axis=1, bitorder="little")
        for r, row in zip(own.tolist(), narrow):
            bodies[r] = row.tobytes()
    for r in np.flatnonzero(exceptions).tolist():
        at = np.flatnonzero(bits[r] > width[r])
        bodies[r] += at.astype("<u2").tobytes() + (rest[r, at] >> width[r]).astype("<u4").tobytes()
    return low, width, exceptions, bodies


def unpack(low, width, exceptions, first, body: bytes, n_ids: int) -> np.ndarray:
    raw = np.frombuffer(body, np.uint8)
    out = np.zeros((len(low), BLOCK), np.uint32)
    for w in np.unique(width).tolist():
        used = BLOCK * w // 8
        if not used:
            continue
        rows = np.flatnonzero(width == w)
        kind, size = ("<u2", 16) if w <= 16 else ("<u4", 32)
        for part in np.array_split(rows, max(1, len(rows) // 256)):
            packed = raw[first[part].astype(np.int64)[:, None] + np.arange(used)]
            if w == 16:
                out[part] = packed.view("<u2")
                continue
            planes = np.zeros((len(part), BLOCK, size), np.uint8)
            planes[:, :, :w] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(part), BLOCK, w)
            out[part] = np.packbits(planes.reshape(len(part), -1), axis=1, bitorder="little").view(kind)
    for r in np.flatnonzero(exceptions).tolist():
        k, at = int(exceptions[r]), int(first[r]) + BLOCK * int(width[r]) // 8
        where = np.frombuffer(body, "<u2", k, at)
        out[r, where] |= np.frombuffer(body, "<u4", k, at + 2 * k) << np.uint32(width[r])
    return (out + low[:, None].astype(np.uint32)).reshape(-1)[:n_ids]


def shard_bytes(doc_ids: list, counts: np.ndarray, ids: np.ndarray, percentiles: tuple[float, ...] = PERCENTILES) -> bytes:
    low, width, exceptions, first, body = pack(ids, percentiles)
    null = np.array([d is None for d in doc_ids], np.uint8)
    named = np.array([0 if d is None else d for d in doc_ids], "<i8")
    head = np.array([len(doc_ids), len(ids), len(low)], "<u8").tobytes() + np.array([BLOCK], "<u4").tobytes()
    tables = (named, null, counts.astype("<u8"), low, width, exceptions, first)
    return MAGIC + head + b"".join(t.tobytes() for t in tables) + body


def parse_shard(content: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """(document ids, number of ids of each, all ids) of one shard file."""
    if content[:8] != MAGIC:
        raise ValueError("not a token shard")
    docs, n_ids, blocks = np.frombuffer(content, "<u8", 3, 8).tolist()
    at = 8 + 24 + 4
    tables = []
    for kind, n in (("<i8", docs), ("u1", docs), ("<u8", docs), ("<u4", blocks), ("u1", blocks), ("<u2", blocks), ("<u8", blocks)):
        tables.append(np.frombuffer(content, kind, n, at))
        at += tables[-1].nbytes
    named, null, counts, low, width, exceptions, first = tables
    ids = unpack(low, width, exceptions, first, content[at:], n_ids)
    return [None if z else d for d, z in zip(named.tolist(), null.tolist())], counts.astype(np.int64), ids


def _put(folder: str, name: str, content: bytes) -> None:
    """Write under the attempt's own name, then rename: readers see whole files only."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
    own = f"{base}/_{name}.{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(own) as f:
        f.write(content)
    store.move(own, f"{base}/{name}")


def write_ids(docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = 2, percentiles: tuple[float, ...] = PERCENTILES, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write all ids in ascending id order; returns the manifest (shard, documents, ids), checkpointed."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # the row's number splits a hot or null id over several range partitions; the sample reads ids only
    dealt = (src.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("id", "tie")
             .sortWithinPartitions("id", "tie").select("id", "text"))
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(jvm_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = _encoder(tokenizer_path), TaskContext.get().partitionId()
        names: list = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = seq = 0
        for piece in itertools.chain((s for b in batches for s in slices(b, "text")), [None]):
            if piece is not None:
                flat, counts = enc.encode(piece.column(1).to_pylist())
                ends = np.cumsum(counts)
                flat = np.insert(flat, ends, np.uint32(end_id))
                names += piece.column(0).to_pylist()
                sizes.append(counts + 1)
                ids.append(flat)
                held += len(flat)
            if names and (piece is None or held >= shard_ids):
                name = f"{part:08d}-{seq:08d}.pfor"
                _put(folder, name, shard_bytes(names, np.concatenate(sizes), np.concatenate(ids), percentiles))
                yield pa.RecordBatch.from_pydict({"shard": [name], "docs": pa.array([len(names)], pa.int64()),
                                                  "n_ids": pa.array([held], pa.int64())})
                names, sizes, ids, held, seq = [], [], [], 0, seq + 1

    return dealt.mapInArrow(run, "shard string, docs long, n_ids long").checkpoint(eager=True)


def read_ids(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the shard files; ``start`` counts the ids before the document."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(folder)
             .select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for shard, content in zip(part["shard"], part["content"]):
                names, counts, ids = parse_shard(bytes(content))
                ends = np.cumsum(counts)
                raw = ids.astype("<u4", copy=False)
                yield pd.DataFrame({
                    "doc_id": pd.array(names, dtype="Int64"), "shard": shard, "before": ends - counts, "n_tokens": counts,
                    "ids_crc32": [zlib.crc32(raw[e - c : e]) for c, e in zip(counts.tolist(), ends.tolist())]})

    found = files.mapInPandas(run, "doc_id long, shard string, before long, n_tokens long, ids_crc32 long")
    # one row a shard: the running total of a manifest, not of documents
    first = manifest.select("shard", (F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")).alias("first"))
    if manifest.count() * 64 <= BROADCAST_LIMIT_BYTES:
        first = F.broadcast(first)
    return found.join(first, "shard").select(
        "doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def encode_to_files(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    folder = shared_folder(docs.sparkSession, "token-ids")
    return read_ids(docs.sparkSession, folder, write_ids(docs, tokenizer_path, folder, **options))

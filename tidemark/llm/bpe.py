"""Byte-level BPE over Arrow batches with the tokenizers library (operator 9).

``encode`` gives each text's ids with the character offsets of every token,
``decode`` reverses the byte table: ids -> bytes -> text, where a character
whose bytes are spread over several tokens is put together again, and bytes
that form no character become U+FFFD in the text (the bytes stay exact).

A rank file (base64 token, rank) is turned into a merge table once on the
driver: every split of a token into two known tokens is a merge at that token's
rank, so equal pairs merge in the order the rank file gives.  The table is
bounded by the vocabulary file and shipped as a broadcast.

Nulls and empty texts: no ids, zero tokens, empty bytes.  Repeated rows and null
ids are kept row by row; other columns are not read.  Texts are never cut: very
long ones form a slice of their own.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.llm.word_encoder import ChunkEncoder, load

RANKS = "byte_bpe_multi_50k.tiktoken"


@lru_cache(1)
def byte_table() -> tuple[str, ...]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 256
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return tuple(out)


def rank_table(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def tokenizer_json(ranks: dict[bytes, int]) -> str:
    """The tokenizers library's description of a rank file."""
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers

    table = byte_table()
    shown = {t: "".join(table[b] for b in t) for t in ranks}
    merges = [
        (shown[t[:i]], shown[t[i:]])
        for t in sorted(ranks, key=ranks.__getitem__)
        for i in range(1, len(t))
        if t[:i] in ranks and t[i:] in ranks
    ]
    bpe = models.BPE(vocab={shown[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    tok = Tokenizer(bpe)
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    tok.decoder = decoders.ByteLevel()
    return tok.to_str()


@lru_cache(2)
def _id_bytes(described: str) -> list[bytes]:
    back = {c: b for b, c in enumerate(byte_table())}
    vocab = json.loads(described)["model"]["vocab"]
    out = [b""] * (max(vocab.values(), default=-1) + 1)
    for token, i in vocab.items():
        out[i] = bytes(back[c] for c in token)
    return out


def offsets(data: bytes, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character offsets of tokens that follow each other in ``data`` and are so many bytes wide.

    A token that holds a part of a character spans the whole character.
    """
    # the number of the character that each byte belongs to
    char = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
    ends = np.cumsum(widths)
    return char[ends - widths], char[ends - 1] + 1


def _encoded(enc: ChunkEncoder, texts: list[str]) -> list[pa.ListArray]:
    """ids, starts and ends of each text."""
    ids, counts = enc.encode(texts)
    starts, ends = offsets("".join(texts).encode(), enc.width[ids])
    chars = np.cumsum([0, *map(len, texts)])
    rows = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    before = np.repeat(chars[:-1], counts)
    return [pa.ListArray.from_arrays(rows, x.astype(np.int32)) for x in (ids, starts - before, ends - before)]


def _decoded(table: list[bytes], ids: pa.ListArray, with_text: bool) -> list[pa.Array]:
    """n_tokens, packed ids, bytes and text of each id sequence."""
    ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False)
    rows = [flat[i:j] for i, j in zip(ends, ends[1:])]
    data = [b"".join(map(table.__getitem__, r.tolist())) for r in rows]
    columns = [pa.array(map(len, rows), pa.int64()), pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary()), pa.array(data, pa.binary())]
    return columns + [pa.array([d.decode("utf-8", "replace") for d in data], pa.string())] * with_text


@lru_cache(1)
def _encoder(described: str) -> ChunkEncoder:
    return ChunkEncoder(load(described, from_file=False), 150_000)  # a worker serves other stages too


ENCODED = "ids array<int>, starts array<int>, ends array<int>"


def encode(docs: DataFrame, described, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, starts, ends): token ids and character offsets of each text.

    ``described`` is a broadcast of :func:`tokenizer_json`.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {src.schema['id'].dataType.simpleString()}, {ENCODED}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(described.value)
        for batch in batches:
            for part in slices(batch, "text"):
                lists = _encoded(enc, ["" if t is None else t for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], names=["id", "ids", "starts", "ends"])

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, described, id_col: str = "doc_id", ids_col: str = "ids", with_text: bool = True) -> DataFrame:
    """(id, n_tokens, packed, data[, text]) of each id sequence.

    ``packed``: the ids as little-endian unsigned 32-bit integers; ``data``: the
    decoded bytes; ``text``: the bytes as characters.
    """
    src = encoded.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    schema = f"id {src.schema['id'].dataType.simpleString()}, n_tokens long, packed binary, data binary" + ", text string" * with_text
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _id_bytes(described.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 64):  # some rows at a time: their ids become Python numbers
                part = batch.slice(a, 64)
                ids = pa.ListArray.from_arrays(_rebased(part.column(1)), part.column(1).flatten())
                yield pa.RecordBatch.from_arrays([part.column(0), *_decoded(table, ids, with_text)], names=names)

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def _rebased(lists: pa.ListArray) -> pa.Array:
    """Offsets of a sliced list array, from zero."""
    return pa.array(lists.offsets.to_numpy() - lists.offsets[0].as_py(), pa.int32())


def round_trip(docs: DataFrame, described, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, packed, data): ``decode(encode(docs))`` in one pass over the texts, ids never leave the task."""
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {src.schema['id'].dataType.simpleString()}, n_tokens long, packed binary, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, table = _encoder(described.value), _id_bytes(described.value)
        for batch in batches:
            for part in slices(batch, "text", 1_000_000):
                ids = _encoded(enc, ["" if t is None else t for t in part.column(1).to_pylist()])[0]
                yield pa.RecordBatch.from_arrays([part.column(0), *_decoded(table, ids, False)], names=["id", "n_tokens", "packed", "data"])

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of what ``decode`` or ``round_trip`` returns."""
    return decoded.select(id_col, "n_tokens", F.sha2("packed", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


def described_ranks(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(tokenizer_json(rank_table(path)))

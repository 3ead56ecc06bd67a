"""Whole texts in bounded blocks, their words as hashes, and compact sorted keys.

Operators that count something over the corpus and bring it back to every text work
on blocks: ``blocks`` merges equal texts within each task, deals the distinct ones out
by their hash and packs what goes to one block.  A block asks buckets of the key space
for what it holds, each distinct key once, so traffic follows the distinct keys of a
block and no count table is ever broadcast.
"""

from __future__ import annotations

import hashlib
import itertools
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOLD_BYTES = 8_000_000  # distinct text a task holds before it sends
SLICE_BYTES = 500_000


# ------------------------------------------------------------------ packing

def squeeze(values: np.ndarray) -> bytes:
    """Unsigned 64-bit values by byte planes; small values cost little."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 1)


def expand(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys, as differences."""
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def expand_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data), dtype=np.uint64)


def pack_texts(rows: list[tuple[bytes, bytes, int]]) -> bytes:
    """(sha, text, weight) rows as one payload."""
    head = struct.pack("<I", len(rows)) + np.array([len(t) for _, t, _ in rows], "<u4").tobytes()
    head += np.array([w for *_, w in rows], "<i8").tobytes()
    return zstandard.compress(head + b"".join(s for s, *_ in rows) + b"".join(t for _, t, _ in rows), 1)


def unpack_texts(payload: bytes) -> Iterator[tuple[bytes, bytes, int]]:
    data = zstandard.decompress(payload)
    n = struct.unpack_from("<I", data)[0]
    sizes = np.frombuffer(data, "<u4", n, 4).tolist()
    weights = np.frombuffer(data, "<i8", n, 4 + 4 * n).tolist()
    at, text_at = 4 + 12 * n, 4 + 44 * n
    for k, (size, weight) in enumerate(zip(sizes, weights)):
        yield data[at + 32 * k : at + 32 * k + 32], data[text_at : text_at + size], weight
        text_at += size


def release() -> None:
    """Give memory that Arrow holds for later back: a worker process serves stage after stage."""
    pa.default_memory_pool().release_unused()


def blocks(texts: DataFrame, n_blocks: int) -> DataFrame:
    """(block, payload) of ``texts`` (text string not null, weight long): equal texts are merged, weights added up.

    A text may come once from every task, and again after HOLD_BYTES, never once for every copy.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        size = 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                weights = batch.column(1).to_pylist()
                for text, weight in zip(batch.column(0), weights):
                    raw = text.as_buffer().to_pybytes()
                    sha = hashlib.sha256(raw).digest()
                    if sha in held:
                        held[sha][1] += weight
                    else:
                        held[sha] = [raw, weight]
                        size += len(raw)
            if held and (batch is None or size > HOLD_BYTES):
                parts: dict[int, list] = {}
                for sha, (raw, weight) in held.items():
                    parts.setdefault(int.from_bytes(sha[:8], "big") % n_blocks, []).append((sha, raw, weight))
                for b, rows in parts.items():
                    yield pa.RecordBatch.from_pydict({"block": pa.array([b], pa.int64()), "payload": pa.array([pack_texts(rows)], pa.binary())})
                held, size = {}, 0
                del parts
                release()

    return texts.select("text", F.col("weight").cast("long")).mapInArrow(run, "block long, payload binary")


def texts_of(payloads) -> tuple[list[str], list[bytes], np.ndarray]:
    """(sha in hex, text, weight) of a block's distinct texts, in the order of their hashes."""
    held: dict[bytes, list] = {}
    for payload in payloads:
        for sha, text, weight in unpack_texts(payload):
            if sha in held:
                held[sha][1] += weight
            else:
                held[sha] = [text, weight]
    order = sorted(held)
    return [s.hex() for s in order], [held[s][0] for s in order], np.array([held[s][1] for s in order], np.int64)


def slices_of(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, texts) of runs of whole texts of about SLICE_BYTES."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_BYTES or i + 1 == len(texts):
            yield first, texts[first : i + 1]
            first, size = i + 1, 0


# ------------------------------------------------------------------ words

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = np.random.default_rng(20_240_101).integers(1, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.full(size, _BASE, np.uint64))
    down = np.cumprod(np.full(size, pow(_BASE, -1, 1 << 64), np.uint64))
    return up, down


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


class Words:
    """The words [^\\x20\\x09-\\x0D]+ of some texts, A-Z lower-cased.

    hashes: 64 bits of each word, all texts in a row; counts: words of each text;
    bytes: the words with one space after each, and instead of a text's last space,
    or for a text without words, ``end``; sizes: bytes of each text in that form.
    """

    def __init__(self, texts: list[bytes], end: int = 0x0A):
        data = b"\n".join(texts).lower() + b"\n"
        a = np.frombuffer(data, np.uint8)
        size = 1 << max(20, (len(a) - 1).bit_length())
        up, down = _powers(size)
        stops = np.cumsum([len(t) + 1 for t in texts]) - 1
        starts = np.concatenate([[0], stops[:-1] + 1])
        inside = ~_SPACE[a]
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        first, last = edges[0::2], edges[1::2]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[a] * up[: len(a)])])
        self.hashes = mixed((total[last] - total[first]) * down[first])
        at = np.searchsorted(first, np.append(starts, len(a)))
        self.counts = np.diff(at)
        self._form = (a, inside, last, at, stops, starts, end)

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, sizes), see above."""
        a, inside, last, at, stops, starts, end = self._form
        out, keep = a.copy(), inside.copy()
        keep[last], out[last] = True, 0x20
        full = self.counts > 0
        out[last[at[1:][full] - 1]] = end
        keep[stops[~full]], out[stops[~full]] = True, end
        return out[keep], np.add.reduceat(keep.astype(np.int64), starts)

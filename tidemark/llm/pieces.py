"""SentencePiece merge-type encoding by backtracking, and decoding (operator 11).

A sequence of pieces is the merge-type (BPE) encoding of its characters exactly if
every two neighbours are compatible: merging the characters of the two again, best
score first, gives those two.  So the encoder needs no merge queue over a text.  It
takes the longest piece at a place (Aho-Corasick over the reversed pieces finds all of
them in one pass over many words), goes to shorter prefixes while the piece doesn't
fit its left neighbour or ends at a place known to fail, and steps back over the last
piece when none is left, marking the place in a bitfield.  No place fails twice, so the
work is linear.

Texts are cut where no piece of the vocabulary can cross (before a space that follows
another character, around line ends and tabs; checked against the vocabulary when it
is loaded), and each distinct unit is encoded once per worker while it is remembered.
Characters that no piece holds become byte pieces.  Decoding is the library's.

Only what such a model may do is supported, the rest raises: merge type, identity
normalisation, a leading space, spaces kept, byte fallback, no user-defined pieces.

Nulls and empty texts: the begin and end ids only, decoded to the empty text.  Repeated
rows and null ids are kept row by row; other columns are not read; an empty table gives
no rows.  Texts are never cut off: a very long one is a slice of its own, and a very
long unit is encoded whole, and not remembered.  Equal scores go to the leftmost pair,
as in the library.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, slices
from tidemark.llm.word_encoder import _Numbered

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
NEVER = float("-inf")
REMEMBERED = 600_000  # units a worker keeps; this only saves time
LONGEST = 64  # characters of a unit that is kept
PAIRS = 1_000_000  # compatibility checks a worker keeps; this only saves time
TOGETHER = 2_000  # units whose matches are searched in one pass


class Pieces:
    """The pieces of a model file: scores, byte fallback, and what the backtracking looks up."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = lib.get_piece_size()
        self.names = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))]
        self.byte = {int(self.names[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        self._require(lib)
        self.id = {self.names[i]: i for i in plain}
        self.score = {self.names[i]: lib.get_score(i) for i in plain}
        self.letters = set().union(*self.id)
        if not self.letters <= self.id.keys():
            raise ValueError("characters that stand only inside longer pieces are not supported")
        self.units = re.compile(self._unit_pattern()).findall
        # pieces that merging never gives (other merges come first) can't be part of an encoding
        reached = [p for p in self.id if len(p) == 1 or self.merged(p) == [p]]
        self.text = {self.id[p]: p for p in reached}
        self.size = {self.id[p]: len(p) for p in reached}
        self.shorter = {i: next((self.id[p[:k]] for k in range(len(p) - 1, 0, -1) if self.id.get(p[:k]) in self.text), -1)
                        for i, p in self.text.items()}
        self.machine = ahocorasick.Automaton()
        for i, p in self.text.items():
            self.machine.add_word(p, i)
        self.machine.make_automaton()
        self.fits: dict[int, bool] = {}

    def _require(self, lib) -> None:
        """Raise unless the model's own answers show the supported settings."""
        probe = ["a  b", " a", "ﬁ", "á", "\t", ""]
        spaced = ["".join(lib.id_to_piece(i) if not lib.is_byte(i) else chr(0) for i in lib.encode(t)) for t in probe]
        if len(self.byte) != 256 or spaced[:2] != [SPACE + "a" + SPACE * 2 + "b", SPACE * 2 + "a"] or spaced[5] \
                or [lib.decode(lib.encode(t)) for t in probe] != probe:
            raise ValueError("only merge-type models with byte fallback, a leading space and no normalisation are supported")

    def _unit_pattern(self) -> str:
        """Where no piece goes on: before a space that follows something, around marks, line ends and tabs."""
        pairs = {pair for p in self.id for pair in zip(p, p[1:]) if pair[0] != SPACE}
        if any(b == SPACE for _, b in pairs):
            raise ValueError("pieces that go on over a space are not supported")
        # the marks that stand in no piece next to anything but marks and a space before them
        marks = {c for c in self.letters if c != SPACE and not (c.isalpha() or c.isdecimal())}
        while bad := {m for pair in pairs for m in marks.intersection(pair) if not marks.issuperset(pair)}:
            marks -= bad
        alone = "".join(c for c in "\n\t" if c not in self.letters)
        marks = re.escape("".join(sorted(marks)))
        words = re.escape(" " + alone) + marks
        self.cuts, self.marks = " " + alone, marks  # a unit may always begin with these; or with marks after what is no mark
        options = [f"[{alone}]"] * bool(alone) + [f" *[{marks}]+"] * bool(marks) + [f" *[^{words}]+", " +"]
        return "|".join(options)

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging neighbours, best score first, then leftmost."""
        parts, score = list(text), self.score.get
        scores = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > NEVER:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = score(parts[i - 1] + parts[i], NEVER)
            if i < len(scores):
                scores[i] = score(parts[i] + parts[i + 1], NEVER)
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the characters of both pieces again gives the two."""
        key = left << 32 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            a, b = self.text[left], self.text[right]
            known = self.fits[key] = self.merged(a + b) == [a, b]
        return known

    def longest(self, unit: str, pos: int) -> int:
        """The longest piece that begins at a place the first pass did not come to; -1 if none does."""
        rest = unit[pos:]
        k = self.machine.longest_prefix(rest)
        while k and self.id.get(rest[:k]) not in self.text:
            k -= 1
        return self.id[rest[:k]] if k else -1

    def encoded(self, units: list[str]) -> list[list[int]]:
        """The ids of each unit (spaces already shown as in pieces)."""
        joined, size = "\0".join(units), self.size
        # one pass: leftmost longest matches, each beginning where the one before ended
        first = {end + 1 - size[i]: i for end, i in self.machine.iter_long(joined)}
        out, at = [], 0
        for unit in units:
            out.append(self._backtracked(unit, first, at))
            at += len(unit) + 1
        return out

    def _backtracked(self, unit: str, first: dict[int, int], at: int) -> list[int]:
        size, shorter, fits = self.size, self.shorter, self.fits
        pos, ids, floor = 0, [], 0
        failed = bytearray((len(unit) >> 3) + 1)  # a bit a place: what begins there can't follow what stands before
        while pos < len(unit):
            if unit[pos] not in self.letters:  # no piece holds it, so what stands before is final
                ids += [self.byte[b] for b in unit[pos].encode()]
                pos, floor = pos + 1, len(ids)
                continue
            token = first.get(at + pos)
            if token is None:
                token = self.longest(unit, pos)
            while True:
                while token >= 0:
                    to = pos + size[token]
                    if not failed[to >> 3] >> (to & 7) & 1:
                        if len(ids) == floor:
                            break
                        fit = fits.get(ids[-1] << 32 | token)
                        if self.compatible(ids[-1], token) if fit is None else fit:
                            break
                    token = shorter[token]
                if token >= 0:
                    break
                if len(ids) == floor:
                    raise ValueError(f"no encoding of {unit!r}")
                failed[pos >> 3] |= 1 << (pos & 7)
                token = ids.pop()
                pos -= size[token]
                token = shorter[token]
            ids.append(token)
            pos = to
        return ids


class PieceEncoder:
    """Encodes texts unit by unit, remembering units."""

    def __init__(self, pieces: Pieces, remembered: int = REMEMBERED):
        self.pieces, self.remembered = pieces, remembered
        self.clear()

    def clear(self) -> None:
        self.at = _Numbered()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)  # by number of a unit: its ids' place and number
        self.size = np.zeros(1 << 14, np.int64)
        self.known = self.used = 0

    def _learn(self, units: list[str]) -> None:
        for i in range(0, len(units), TOGETHER):
            got = self.pieces.encoded([u.replace(" ", SPACE) for u in units[i : i + TOGETHER]])
            sizes = np.fromiter(map(len, got), np.int64, len(got))
            ids = np.fromiter(itertools.chain.from_iterable(got), np.uint32, int(sizes.sum()))
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            while self.known + len(got) > len(self.begin):
                self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
            self.ids[self.used : self.used + len(ids)] = ids
            own = slice(self.known, self.known + len(got))
            self.begin[own], self.size[own] = self.used + np.cumsum(sizes) - sizes, sizes
            self.used += len(ids)
            self.known += len(got)

    def encode(self, texts: list[str], lead: str = " ") -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row without begin and end ids, and the number of ids of each text.

        ``lead`` is what the model sets before a text; parts of a text that begin where a unit may are encoded without.
        """
        if len(self.at) > self.remembered or self.used > 16 * self.remembered:
            self.clear()
        flat: list[str] = []
        n = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text:
                own = self.pieces.units(lead + text.replace(SPACE, " "))
                n[k] = len(own)
                flat += own
        numbers = np.fromiter(map(self.at.__getitem__, flat), np.int64, len(flat))
        new = list(itertools.islice(reversed(self.at), self.at.given - self.known))[::-1]
        self._learn(new)
        for unit in new:
            if len(unit) > LONGEST:
                del self.at[unit]
        each = self.size[numbers]
        ends = np.cumsum(each)
        at = np.repeat(self.begin[numbers] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)
        total = np.concatenate([[0], ends])
        return self.ids[at], np.diff(total[np.concatenate([[0], np.cumsum(n)])])


@lru_cache(1)
def encoder(model_file: str) -> PieceEncoder:
    return PieceEncoder(Pieces(model_file))


def _source(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return src, src.schema["id"].dataType.simpleString()


def encode(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", ends: bool = True) -> DataFrame:
    """(id, ids): the piece ids of each text, with the model's begin and end ids unless ``ends`` is False."""
    prepare(docs.sparkSession)
    src, kind = _source(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_file)
        for part in (p for b in batches for p in slices(b, "text", 1_000_000)):
            rows = pa.array([r.astype(np.int32) for r in _rows(enc, part.column(1).to_pylist(), ends)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column(0), rows], names=["id", "ids"])

    return src.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def _rows(enc: PieceEncoder, texts: list[str | None], ends: bool) -> list[np.ndarray]:
    flat, counts = enc.encode([t or "" for t in texts])
    rows = np.split(flat, np.cumsum(counts)[:-1])
    if not ends:
        return rows
    lib = enc.pieces.library
    first, last = np.array([lib.bos_id()], np.uint32), np.array([lib.eos_id()], np.uint32)
    return [np.concatenate([first, r, last]) for r in rows]


def decode(encoded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, n_tokens, packed, text) of each id sequence; ``packed``: ids as little-endian unsigned 32-bit integers."""
    prepare(encoded.sparkSession)
    src = encoded.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    schema = f"id {src.schema['id'].dataType.simpleString()}, {_DECODED}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lib = encoder(model_file).pieces.library
        for batch in batches:
            for a in range(0, batch.num_rows, 64):  # some rows at a time: their ids become Python numbers
                part = batch.slice(a, 64)
                rows = [np.array(r, np.uint32) for r in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), *_decoded(lib, rows)], names=["id", "n_tokens", "packed", "text"])

    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)


_DECODED = "n_tokens long, packed binary, text string"


def _decoded(lib, rows: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array(map(len, rows), pa.int64()), pa.array([r.astype("<u4").tobytes() for r in rows], pa.binary()),
            pa.array([lib.decode(r.tolist()) for r in rows], pa.string())]


def round_trip(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, packed, text): ``decode(encode(docs))`` in one pass over the texts, ids never leave the task."""
    prepare(docs.sparkSession)
    src, kind = _source(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_file)
        for part in (p for b in batches for p in slices(b, "text", 500_000)):
            rows = _rows(enc, part.column(1).to_pylist(), True)
            yield pa.RecordBatch.from_arrays([part.column(0), *_decoded(enc.pieces.library, rows)], names=["id", "n_tokens", "packed", "text"])

    return src.mapInArrow(run, f"id {kind}, {_DECODED}").withColumnRenamed("id", id_col)


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of what ``decode`` or ``round_trip`` returns."""
    return decoded.select(id_col, "n_tokens", F.sha2("packed", 256).alias("ids_sha256"),
                          F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))

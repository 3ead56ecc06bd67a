"""Alignment of two tokenizers' tokens and corpus-wide link counts (operator 12).

Both tokenizers encode every text; byte offsets where tokens of both end cut them into
groups, and two tokens whose byte ranges overlap are linked.  How many documents hold a
pair of ids linked is counted over the corpus by external counting:

* A task works through chunks of whole texts (some MB; equal texts once, with their
  number).  A chunk's (pair, document, times) records are sorted side-major (bucket of
  the first id, first id, second id) and written as one zstd run for each of RADIX buckets.
* Runs of a bucket are merged by k-way heap merges of at most FAN_IN runs, page by page,
  as often as needed: the table of a bucket is bounded by the vocabularies, and so is a
  page.  In the last merge all pairs of a first id come one after the other, so its
  highest count is known when the next id begins.
* The runs stream past their bucket's counts once more (FAN_IN of them a task) and give
  back, by document, how many links have the highest count and the sum of the counts.

The records of a document stay with its chunk's runs; what is shuffled are keys and
counts of distinct pairs, and one small sum by document and bucket.

Texts are encoded unit by unit (a run of white space and what follows it), as neither
tokenizer's tokens go on over a unit's edge; a worker remembers units, with their links.

Null and empty texts, and texts whose joined token bytes of either side differ from the
space and the text (such as one with U+2581), have no tokens.  Repeated rows and ids are
documents of their own; null ids are kept; other columns are not read; an empty table
gives no rows.  A very long text is a chunk of its own, held whole by one task.  Equal
counts are all the highest.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, slices, staged
from tidemark.llm.pieces import SPACE, PieceEncoder, Pieces
from tidemark.llm.text_blocks import expand, expand_sorted, release, squeeze, squeeze_sorted
from tidemark.llm.word_encoder import OTHER_WHITE, _Numbered, load

RADIX = 64  # buckets of first ids
FAN_IN = 256  # runs of a bucket that one task merges
CHUNK_BYTES = 4_000_000  # text of a chunk
CHUNK_ROWS = 50_000
PAGE = 65_536  # pairs of a merged run's page
REMEMBERED = 500_000  # units a worker keeps; this only saves time
LONGEST = 64  # characters of a unit that is kept
# Latin letters and digits, ASCII marks, and white space by some readings only (a text that holds one is one unit).
LATIN = "0-9A-Za-zÀ-ÖØ-öø-ɏ"
ASCII_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
UNSURE = "\x1c\x1d\x1e\x1f\u180e"


# ------------------------------------------------------------------ one text

def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first side's token, of the second's) of all pairs whose byte ranges overlap."""
    first = np.searchsorted(b_ends, np.concatenate([[0], a_ends[:-1]]), "right")
    last = np.searchsorted(b_ends, a_ends, "left")
    each = last - first + 1
    total = np.cumsum(each)
    a = np.repeat(np.arange(len(a_ends)), each)
    return a, np.arange(total[-1] if len(total) else 0) - np.repeat(total - each - first, each)


def groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(common ends, group of each token of the first side, of the second)."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    return common, np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)


def shown(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray) -> list[str]:
    """Every token's id and the mark after it, in the order of ``a1,a2|b1;a3|b2,b3;``."""
    group = np.concatenate([a_group * 2, b_group * 2 + 1])
    order = np.argsort(group, kind="stable")
    group = group[order]
    last = np.concatenate([group[1:] != group[:-1], [True]]) if len(group) else np.zeros(0, bool)
    mark = np.where(last, 1 + (group & 1), 0)
    return [f"{i}{',|;'[m]}" for i, m in zip(np.concatenate([a, b])[order].tolist(), mark.tolist())]


class Aligner:
    """Both encodings, links and groups of units; remembers units."""

    def __init__(self, a_file: str, b_file: str, remembered: int = REMEMBERED):
        self.a = load(a_file)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        if any(not t.special for t in self.a.get_added_tokens_decoder().values()):
            raise ValueError("added tokens that aren't special are not supported")
        vocab = self.a.get_vocab()
        self.a_width = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.a_width[i] = len(token)  # one printable character stands for one byte
        self.b = PieceEncoder(Pieces(b_file), 100_000)
        names, back = self.b.pieces.names, {i: 1 for i in self.b.pieces.byte.values()}
        self.b_width = np.array([back.get(i) or len(n.replace(SPACE, " ").encode()) for i, n in enumerate(names)], np.int64)
        self.units = re.compile(self._unit_pattern()).findall
        self.remembered = remembered
        self.clear()

    def _unit_pattern(self) -> str:
        """No token goes on into white space (by its first character, if no piece does), nor from a letter or digit into a mark."""
        white, pieces = "\n \t" + OTHER_WHITE, self.b.pieces
        inner = re.escape("".join(c for c in white if c not in pieces.cuts))
        marks = re.escape("".join(c for c in ASCII_MARKS if c in pieces.marks))
        white, cuts = re.escape(white), re.escape(pieces.cuts)
        before_mark = f"[{cuts}]?[{LATIN}]+(?=[{marks}])|" if marks else ""
        return f"{before_mark}[{white}]*[^{white}]+(?:[{inner}][{white}]*[^{white}]+)*(?:[{inner}][{white}]*\\Z)?|[{white}]+"

    def _first_ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The first tokenizer's ids of all units, and how many each has; units that may follow each other are one text."""
        text, first = [], []  # the texts, and the first unit of each
        for n, u in enumerate(units):
            if not text or u[0] not in " \n\t" or units[n - 1][-1].isspace() or units[n - 1][-1] in OTHER_WHITE or n - first[-1] >= 500:
                text.append([])
                first.append(n)
            text[-1].append(u)
        ids = np.concatenate([np.array(e.ids, np.int64) for e in self.a.encode_batch_fast(["".join(t) for t in text], add_special_tokens=False)])
        ends = np.cumsum(np.fromiter((len(u.encode()) for u in units), np.int64, len(units)))
        stops = np.searchsorted(np.cumsum(self.a_width[ids]), ends) + 1
        return ids, np.diff(stops, prepend=0)

    def clear(self) -> None:
        self.at = _Numbered()
        self.known = 0
        self.sizes = np.zeros((1 << 14, 4), np.int64)  # tokens of both sides, groups, links
        self.text: list[str] = []
        self.begin = np.zeros(1 << 14, np.int64)
        self.pair = np.zeros(1 << 16, np.int32)  # numbers of the linked pairs, unit by unit
        self.used = 0
        self.pair_at: dict[int, int] = {}
        self.pairs = np.zeros(1 << 16, np.int64)  # a pair's ids, by its number

    def _room(self, units: int, links: int, pairs: int) -> None:
        while units > len(self.begin):
            self.begin, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.sizes))
        while links > len(self.pair):
            self.pair = np.concatenate([self.pair, np.zeros_like(self.pair)])
        while pairs > len(self.pairs):
            self.pairs = np.concatenate([self.pairs, np.zeros_like(self.pairs)])

    def _learn(self, units: list[str]) -> None:
        a, n_a = self._first_ids(units)
        b, n_b = self.b.encode(units, "")
        a_ends, b_ends = np.cumsum(self.a_width[a]), np.cumsum(self.b_width[b])
        unit_ends = np.cumsum([len(u.encode()) for u in units])
        a_stop, b_stop = np.cumsum(n_a), np.cumsum(n_b)
        if not (np.array_equal(a_ends[a_stop - 1], unit_ends) and np.array_equal(b_ends[b_stop - 1], unit_ends)):
            raise ValueError("token bytes differ from a text that both vocabularies cover")
        common, a_group, b_group = groups(a_ends, b_ends)
        of_a, of_b = links(a_ends, b_ends)
        key, number = np.unique(a[of_a].astype(np.int64) << 32 | b[of_b], return_inverse=True)
        numbers = np.fromiter((self.pair_at.setdefault(k, len(self.pair_at)) for k in key.tolist()), np.int64, len(key))
        n_links = np.diff(np.searchsorted(of_a, a_stop), prepend=0)
        n_groups = np.diff(np.searchsorted(common, unit_ends, "right"), prepend=0)
        marks = shown(a, b, a_group, b_group)
        own = slice(self.known, self.known + len(units))
        self._room(own.stop, self.used + len(of_a), len(self.pair_at))
        self.pairs[numbers] = key
        self.pair[self.used : self.used + len(of_a)] = numbers[number]
        self.sizes[own] = np.stack([n_a, n_b, n_groups, n_links], axis=1)
        self.begin[own] = self.used + np.cumsum(n_links) - n_links
        stops = np.cumsum(n_a + n_b).tolist()
        self.text += ["".join(marks[i:j]) for i, j in zip([0, *stops], stops)]
        self.used += len(of_a)
        self.known += len(units)

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The units of all texts by their numbers, and how many each text has."""
        flat: list[str] = []
        n = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):
            if text and SPACE not in text:
                own = [" " + text] if any(c in text for c in UNSURE) else self.units(" " + text)
                n[k] = len(own)
                flat += own
        found = np.fromiter(map(self.at.__getitem__, flat), np.int64, len(flat))
        new = list(itertools.islice(reversed(self.at), self.at.given - self.known))[::-1]
        for i in range(0, len(new), 5_000):
            self._learn(new[i : i + 5_000])
        for unit in new:
            if len(unit) > LONGEST:
                del self.at[unit]
        return found, n

    def links_of(self, units: np.ndarray) -> np.ndarray:
        """The numbers of the linked pairs of some units in a row."""
        each = self.sizes[units, 3]
        ends = np.cumsum(each)
        return self.pair[np.repeat(self.begin[units] - ends + each, each) + np.arange(ends[-1] if len(ends) else 0)]

    def begin_chunk(self) -> None:
        """Numbers stay the same within a chunk."""
        if len(self.at) > self.remembered or self.used > 32 * self.remembered:
            self.clear()


# ------------------------------------------------------------------ runs

_WIDE = np.int64(RADIX)


def side_major(pairs: np.ndarray) -> np.ndarray:
    """Keys that ascend by bucket, first id, second id."""
    a = pairs >> 32
    return (a % _WIDE) << 52 | (a // _WIDE) << 32 | (pairs & 0xFFFFFFFF)


def firsts(keys: np.ndarray) -> np.ndarray:
    """What tells the first ids of one bucket's keys apart."""
    return keys >> np.uint64(32)


class _Chunk:
    """The records of some texts; equal texts are one slot."""

    def __init__(self, aligner: Aligner):
        self.aligner = aligner
        aligner.begin_chunk()
        self.slots: dict[bytes, int] = {}
        self.weight: list[int] = []
        self.rows: list[tuple] = []
        self.slot_rows: list[tuple] = []
        self.links: list[np.ndarray] = []
        self.links_slot: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: pa.Array, texts: list[str]) -> list[int]:
        """The slot of each row."""
        own, new = [], []
        for text in texts:
            sha = hashlib.sha256(text.encode()).digest()
            slot = self.slots.setdefault(sha, len(self.slots))
            if slot == len(self.weight):
                self.weight.append(0)
                new.append(text)
            self.weight[slot] += 1
            own.append(slot)
        if new:
            self._describe(new)
        self.size += sum(map(len, texts))
        return own

    def _describe(self, texts: list[str]) -> None:
        al, first = self.aligner, len(self.slot_rows)
        units, n = al.numbers(texts)
        ends = np.cumsum(n)
        total = np.concatenate([np.zeros((1, 4), np.int64), np.cumsum(al.sizes[units], axis=0)])
        sums = total[ends] - total[ends - n]
        text_of, flat = al.text, units.tolist()
        for i, j, s in zip((ends - n).tolist(), ends.tolist(), sums.tolist()):
            sha = hashlib.sha256("".join([text_of[u] for u in flat[i:j]])[:-1].encode()).hexdigest() if j > i else ""
            self.slot_rows.append((*s, sha))
        self.links.append(al.links_of(units))
        self.links_slot.append(np.repeat(np.arange(first, first + len(texts), dtype=np.int32), sums[:, 3]))

    def runs(self) -> list[tuple]:
        """(bucket, keys, counts, records of each key, slots, times), packed."""
        number, slot = np.concatenate(self.links), np.concatenate(self.links_slot)
        if not len(number):
            return []
        seen = np.zeros(len(self.aligner.pair_at), bool)
        seen[number] = True
        own = np.flatnonzero(seen)
        keys = side_major(self.aligner.pairs[own])
        order = np.argsort(keys)
        keys, rank = keys[order], np.zeros(len(seen), np.int64)
        rank[own[order]] = np.arange(len(own))
        record = rank[number] * len(self.slots) + slot
        record.sort()
        first = np.flatnonzero(np.concatenate([[True], record[1:] != record[:-1]]))
        times = np.diff(np.append(first, len(record)))
        of_key, slot = np.divmod(record[first], len(self.slots))
        begin = np.searchsorted(of_key, np.arange(len(keys)))
        counts = np.add.reduceat(np.array(self.weight, np.int64)[slot], begin)
        sizes = np.diff(np.append(begin, len(slot)))
        at = np.searchsorted(keys, np.arange(RADIX + 1) << 52)
        ends = np.append(begin, len(slot))
        out = []
        for b, (i, j) in enumerate(zip(at, at[1:])):
            if j > i:
                r = slice(ends[i], ends[j])
                out.append((b, squeeze_sorted(keys[i:j].astype(np.uint64)), *map(squeeze, (counts[i:j], sizes[i:j], slot[r], times[r]))))
        return out


@lru_cache(1)
def _aligner(a_file: str, b_file: str) -> Aligner:
    return Aligner(a_file, b_file)


_RUN = ("keys", "counts", "sizes", "slots", "times")
_DOC = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def chunks(docs: DataFrame, a_file: str, b_file: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Staged rows of two kinds: (chunk, bucket, runs) and (chunk, slot, id, its tokens, groups and links)."""
    src = docs.select(F.col("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    schema = f"chunk long, bucket int, {', '.join(c + ' binary' for c in _RUN)}, slot int, id {kind}, {_DOC}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, base, seq = _aligner(a_file, b_file), TaskContext.get().partitionId() << 24, 0
        chunk, ids, slots = None, [], []
        for part in itertools.chain((p for b in batches for p in slices(b, "text", min(500_000, chunk_bytes))), [None]):
            if part is not None:
                chunk = chunk or _Chunk(aligner)
                slots += chunk.add(part.column(0), part.column(1).to_pylist())
                ids.append(part.column(0))
            if chunk and (part is None or chunk.size > chunk_bytes or len(slots) > CHUNK_ROWS):
                yield from _written(base + seq, chunk, ids, slots)
                chunk, ids, slots, seq = None, [], [], seq + 1
                release()

    return staged(src.mapInArrow(run, schema), "alignment-chunks")


def _written(number: int, chunk: _Chunk, ids: list[pa.Array], slots: list[int]) -> Iterator[pa.RecordBatch]:
    names = ["chunk", "bucket", *_RUN, "slot", "id", *(f.split()[0] for f in _DOC.split(", "))]
    kinds = [pa.int64(), pa.int32(), *[pa.binary()] * len(_RUN), pa.int32(), ids[0].type, *[pa.int64()] * 4, pa.string()]
    for row in chunk.runs():
        values = [number, *row, *[None] * (len(names) - 2 - len(_RUN))]
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)
    n = len(slots)
    described = list(zip(*(chunk.slot_rows[s] for s in slots)))
    blank = [pa.nulls(n, t) for t in kinds[1 : 2 + len(_RUN)]]
    columns = [pa.array([number] * n, pa.int64()), *blank, pa.array(slots, pa.int32()), pa.concat_arrays(ids),
               *(pa.array(c, t) for c, t in zip(described, kinds[-5:]))]
    batch = pa.RecordBatch.from_arrays(columns, names=names)
    for i in range(0, n, 10_000):
        yield batch.slice(i, 10_000)


# ------------------------------------------------------------------ merging

def heap_merge(runs: list[list[tuple[bytes, bytes]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ascending (keys, counts) of runs of packed pages; one page of each run is open at a time.

    The heap holds the open pages by their last key: everything up to the least of these
    can be counted, as what follows in any run is greater.
    """
    rest = [iter(pages) for pages in runs]
    heap: list[tuple[int, int]] = []
    open_pages: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def turn(r: int) -> None:
        page = next(rest[r], None)
        if page is None:
            open_pages.pop(r, None)
            return
        keys, counts = expand_sorted(page[0]), expand(page[1])
        open_pages[r] = keys, counts
        heapq.heappush(heap, (int(keys[-1]), r))

    for r in range(len(runs)):
        turn(r)
    while heap:
        bound = heap[0][0]
        taken, used_up = [], []
        while heap and heap[0][0] == bound:
            used_up.append(heapq.heappop(heap)[1])
        for r, (keys, counts) in open_pages.items():
            k = int(np.searchsorted(keys, np.uint64(bound), "right"))
            if k:
                taken.append((keys[:k], counts[:k]))
                open_pages[r] = keys[k:], counts[k:]
        for r in used_up:
            turn(r)
        keys, counts = (np.concatenate(x) for x in zip(*taken))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        yield keys[first], np.add.reduceat(counts[order], first)


def with_maxima(merged: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Adds whether a count is its first id's highest; an id's pairs are given out when the next id begins."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    for block in itertools.chain(merged, [None]):
        if block is not None:
            held.append(block)
            a = firsts(block[0])
            if firsts(held[0][0][:1])[0] == a[-1]:
                continue
        if not held:
            return
        keys, counts = (np.concatenate(x) for x in zip(*held))
        a = firsts(keys)
        done = len(a) if block is None else int(np.searchsorted(a, a[-1]))
        begin = np.flatnonzero(np.concatenate([[True], a[1:done] != a[: done - 1]]))
        highest = np.repeat(np.maximum.reduceat(counts[:done], begin), np.diff(np.append(begin, done)))
        yield keys[:done], counts[:done], counts[:done] == highest
        held = [(keys[done:], counts[done:])] if done < len(a) else []


_PAGES = "bucket int, part long, page int, keys binary, counts binary, best binary"


def _paged(blocks: Iterator[tuple]) -> Iterator[tuple]:
    """Blocks of about a page each."""
    held: list[tuple] = []
    for block in itertools.chain(blocks, [None]):
        if block is not None:
            held.append(block)
            if sum(len(b[0]) for b in held) < PAGE:
                continue
        if held:
            yield tuple(np.concatenate(x) for x in zip(*held))
            held = []


def pair_counts(runs: DataFrame, n_runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """(bucket, part, page, keys, counts, best): in how many documents each pair is linked, merged until each bucket is one run."""

    def merged(last: bool):
        def run(table: pa.Table) -> pa.Table:
            table = table.sort_by([("run", "ascending"), ("page", "ascending")])
            of_run: dict = {}
            for r, keys, counts in zip(*(table.column(c).to_pylist() for c in ("run", "keys", "counts"))):
                of_run.setdefault(r, []).append((keys, counts))
            blocks = heap_merge(list(of_run.values()))
            pages = list(_packed(_paged(with_maxima(blocks) if last else blocks)))
            own = {"bucket": [table.column("bucket")[0].as_py()] * len(pages), "part": [table.column("part")[0].as_py()] * len(pages)}
            columns = dict(zip(("keys", "counts", "best"), zip(*pages)))
            return pa.table({"bucket": pa.array(own["bucket"], pa.int32()), "part": pa.array(own["part"], pa.int64()),
                             "page": pa.array(range(len(pages)), pa.int32()), **{k: pa.array(v, pa.binary()) for k, v in columns.items()}})

        return run

    current = runs.select("bucket", F.col("chunk").alias("run"), F.lit(0).alias("page"), "keys", "counts")
    while True:
        parts = -(-n_runs // fan_in) if n_runs else 1
        part = F.pmod(F.xxhash64("run"), F.lit(parts))
        pages = current.withColumn("part", part).groupBy("bucket", "part").applyInArrow(merged(parts == 1), _PAGES)
        pages = staged(pages, "pair-counts")
        if parts == 1:
            return pages
        current, n_runs = pages.select("bucket", F.col("part").alias("run"), "page", "keys", "counts"), parts


def _packed(pages: Iterator[tuple]) -> Iterator[tuple]:
    for keys, counts, *best in pages:
        yield squeeze_sorted(keys), squeeze(counts), np.packbits(best[0]).tobytes() if best else None


def contributions(runs: DataFrame, counted: DataFrame, n_runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """(chunk, slots, best, sums): for each run, the links with the highest count and the sum of counts by document."""
    parts = max(1, -(-n_runs // fan_in))
    left = runs.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(parts))).select("bucket", "part", "chunk", "keys", "sizes", "slots", "times")
    # a bucket's counts are bounded by the vocabularies; one copy for every FAN_IN runs
    right = counted.select("bucket", "page", "keys", "counts", "best").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))

    def run(runs: pa.Table, counted: pa.Table) -> pa.Table:
        counted = counted.sort_by("page")
        pages = [(expand_sorted(k), expand(c), b) for k, c, b in zip(*(counted.column(c).to_pylist() for c in ("keys", "counts", "best")))]
        keys = np.concatenate([k for k, _, _ in pages]) if pages else np.zeros(0, np.uint64)
        counts = np.concatenate([c for _, c, _ in pages]).astype(np.int64) if pages else np.zeros(0, np.int64)
        best = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(k)) for k, _, b in pages]).astype(np.int64) if pages else counts
        out: dict[str, list] = {"chunk": [], "slots": [], "best": [], "sums": []}
        for i in range(runs.num_rows):
            own, sizes, slots, times = (runs.column(c)[i].as_py() for c in ("keys", "sizes", "slots", "times"))
            at = np.repeat(np.searchsorted(keys, expand_sorted(own)), expand(sizes).astype(np.int64))
            slots, times = expand(slots).astype(np.int64), expand(times).astype(np.int64)
            sums = np.zeros((2, int(slots.max()) + 1), np.int64)
            np.add.at(sums[0], slots, times * best[at])
            np.add.at(sums[1], slots, times * counts[at])
            some = np.flatnonzero(sums[1])
            out["chunk"].append(runs.column("chunk")[i].as_py())
            for name, values in zip(("slots", "best", "sums"), (some, sums[0, some], sums[1, some])):
                out[name].append(squeeze(values))
        return pa.table({"chunk": pa.array(out["chunk"], pa.int64()), **{k: pa.array(out[k], pa.binary()) for k in ("slots", "best", "sums")}})

    return left.groupBy("bucket", "part").cogroup(right.groupBy("bucket", "part")).applyInArrow(run, "chunk long, slots binary, best binary, sums binary")


def aligned(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text",
            chunk_bytes: int = CHUNK_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document."""
    prepare(docs.sparkSession)
    found = chunks(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), a_file, b_file, chunk_bytes)
    runs = found.where(F.col("bucket").isNotNull()).select("chunk", "bucket", *_RUN)
    described = found.where(F.col("bucket").isNull()).select("chunk", "slot", "id", *(f.split()[0] for f in _DOC.split(", ")))
    n_runs = runs.agg(F.countDistinct("chunk")).head()[0]
    counted = pair_counts(runs, n_runs, fan_in)
    given = contributions(runs, counted, n_runs, fan_in)
    kind = described.schema["id"].dataType.simpleString()

    def run(rows: pa.Table, given: pa.Table) -> pa.Table:
        slot = rows.column("slot").to_numpy()
        sums = np.zeros((2, int(slot.max(initial=-1)) + 1), np.int64)
        for slots, best, total in zip(*(given.column(c).to_pylist() for c in ("slots", "best", "sums"))):
            at = expand(slots).astype(np.int64)
            sums[0, at] += expand(best).astype(np.int64)
            sums[1, at] += expand(total).astype(np.int64)
        return pa.table({**{c: rows.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")},
                         "n_best": sums[0, slot], "count_sum": sums[1, slot], "groups_sha256": rows.column("groups_sha256")})

    out = described.groupBy("chunk").cogroup(given.groupBy("chunk")).applyInArrow(
        run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return out.withColumnRenamed("id", id_col)

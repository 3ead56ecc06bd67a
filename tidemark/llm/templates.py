"""Benchmark decontamination by canonical templates (operator 4).

A text becomes a template: numbers, units that follow a number, and names become
typed slots, other words are lower-cased.  Two forms are indexed: ``typed``
(capitalised words are names) and ``plain`` (they are words, for texts whose case
was changed).  Runs of numbers, and of names, are one slot.  Windows of five
template tokens are joined by hash with the windows of the benchmark items; hits
that lie on one diagonal (document position minus item position) are one passage.
A passage's slots must be consistent: every slot value of the item stands for the value
that most windows of the passage give it, so "3 apples ... 3 pears" matches "5 apples
... 5 pears" but loses the windows of "7 pears" against "5 apples ... 7 pears".  Windows
whose slots are equal always count, and a run that goes on beyond the passage's edge is
compared by its part inside ("Question 12. 3 friends" holds "3 friends").  A document
holds an item if ``coverage``, the part of the item's distinct windows found in
consistent passages, is 0.75 or more in either form.

A bitmap of the benchmark's window hashes (two bits a hash; its size follows their
number up to BITS_MOST, beyond which more windows pass, never fewer) filters windows
where documents are read; what passes is joined by the whole hash.  Joins with item
windows broadcast only below the session's size limit.

Items of fewer than five template tokens are one window, which only a document that is
that template as a whole has; without a word outside its slots, slot values are part of
its hash.  Such items are also looked for inside longer documents, word by word and
without regard to case (form ``words``).

Null and empty texts have no windows.  A document is told by its id and text hash:
repeated rows are one entry, null ids are kept.  Of values that are as frequent, the
item's own wins, then the smallest.  Other columns are not read; empty tables give no
rows; texts, very long ones too, are read whole.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, slices, staged
from tidemark.session import small_side

WINDOW = 5
COVERAGE = 0.75
BITS_A_HASH, BITS_LEAST, BITS_MOST = 64, 1 << 16, 1 << 27
REMEMBERED = 400_000  # words a worker process keeps; only saves time

# Words read as numbers or, after a number, as units.
NUMBER_WORDS = frozenset(
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half dozen".split())
UNITS = frozenset(
    "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre "
    "kilometres mg g kg t lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml cl l liter liters litre litres "
    "gallon gallons s sec min h hr second seconds minute minutes hour hours day days week weeks month months year years percent pct "
    "dollar dollars cent cents euro euros usd eur gbp degree degrees kmh mph hz khz mhz ghz w kw v a j kj cal kcal byte bytes kb mb gb tb".split())

LITERAL, NUMBER, UNIT, NAME = range(4)
_SPACED = bytes(b if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_SLOT = np.array([0, 0x51AFD7ED558CCD6D, 0xC4CEB9FE1A85EC53, 0x2545F4914F6CDD1D], np.uint64)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
_NUMBER = re.compile(r"^\d")
FORMS = ("typed", "plain")


class _Words(dict):
    """word -> (hash of the lower-cased word) * 4 + kind, where UNIT means: may be a unit."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        shown = word.decode("utf-8", "replace")
        low = shown.lower()
        if _NUMBER.match(shown) or low in NUMBER_WORDS:
            kind = NUMBER
        elif low in UNITS:
            kind = UNIT
        else:
            kind = NAME if shown[0].isupper() else LITERAL
        n = self[word] = (xxhash.xxh64_intdigest(low.encode()) >> 2 << 2) | kind
        return n


_words = _Words()


def tokens(text: str | bytes | None) -> list[bytes]:
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    return raw.translate(_SPACED).split()


class Template:
    """The template tokens of some texts in a row: hash, kind, first word, text of each token; where each text begins."""

    def __init__(self, coded: np.ndarray, sizes: np.ndarray, form: str):
        kind = (coded & np.uint64(3)).astype(np.int8)
        begins = np.zeros(len(coded) + 1, bool)
        begins[np.cumsum(sizes) - sizes] = True
        begins = begins[:-1]
        after_number = np.concatenate([[False], kind[:-1] == NUMBER]) & ~begins
        kind[(kind == UNIT) & ~after_number] = LITERAL
        if form == "plain":
            kind[kind == NAME] = LITERAL
        again = np.concatenate([[False], (kind[1:] == kind[:-1]) & ((kind[1:] == NUMBER) | (kind[1:] == NAME))]) & ~begins
        self.first = np.flatnonzero(~again)
        self.kind = kind[self.first]
        self.hash = np.where(self.kind == LITERAL, coded[self.first] >> np.uint64(2), _SLOT[self.kind])
        self.ends = np.append(self.first[1:], len(coded))
        self.text = np.repeat(np.arange(len(sizes)), sizes)[self.first]
        self.start = np.searchsorted(self.text, np.arange(len(sizes) + 1))

    def windows(self, form: str) -> tuple[np.ndarray, np.ndarray]:
        """(hash, whether it lies in one text) of five tokens from every place."""
        n = max(0, len(self.hash) - WINDOW + 1)
        out = np.full(n, FORMS.index(form) * 8, np.uint64)
        for i in range(WINDOW):
            out = _folded(out, self.hash[i : i + n], i)
        return _mixed(out), self.text[:n] == self.text[WINDOW - 1 :]

    def whole(self, k: int, form: str, coded: np.ndarray) -> np.uint64:
        """The hash of a text of fewer than five tokens."""
        own = slice(self.start[k], self.start[k + 1])
        out = np.full(1, own.stop - own.start + FORMS.index(form) * 8, np.uint64)
        parts = list(self.hash[own, None])
        if (self.kind[own] != LITERAL).all():
            parts += list(coded[self.first[own.start] : self.ends[own.stop - 1], None] >> np.uint64(2))
        for i, part in enumerate(parts):
            out = _folded(out, part, i)
        return _mixed(out)[0]

    def slots(self, words: list[bytes], at: int, size: int) -> list[str]:
        """The values of a window's slots, in their order."""
        return [b" ".join(words[self.first[i] : self.ends[i]]).decode("utf-8", "replace") for i in range(at, at + size) if self.kind[i] != LITERAL]


def _folded(h: np.ndarray, part: np.ndarray, i: int) -> np.ndarray:
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + part * _FACTORS[i % len(_FACTORS)]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def phrase_hashes(coded: np.ndarray, size: int) -> np.ndarray:
    """One hash for ``size`` words, without regard to case, from every place."""
    n = max(0, len(coded) - size + 1)
    out = np.full(n, size * 32 + 31, np.uint64)
    for i in range(size):
        out = _folded(out, coded[i : i + n] >> np.uint64(2), i)
    return _mixed(out)


class Bitmap:
    """Which hashes may be wanted: two bits each, from its upper and its lower end."""

    def __init__(self, packed: bytes):
        self.bits = np.frombuffer(packed, np.uint8)
        self.width = len(packed).bit_length() + 2  # 2^width bits

    def places(self, h: np.ndarray, upper: bool) -> np.ndarray:
        return ((h >> np.uint64(64 - self.width)) if upper else h & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        """The places of hashes whose two bits are set."""
        at = np.arange(len(h))
        for upper in (True, False):
            p = self.places(h[at], upper)
            at = at[(self.bits[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)]
        return at


def bitmap(hashes: DataFrame) -> Bitmap:
    """The bitmap of a column ``hash``, put together from words of 64 bits (at most BITS_MOST / 64 rows)."""
    n = hashes.count()
    width = min(BITS_MOST, max(BITS_LEAST, BITS_A_HASH * n)).bit_length() - 1
    places = F.explode(F.array(F.shiftrightunsigned("hash", 64 - width), F.col("hash").bitwiseAND(F.lit((1 << width) - 1))))
    words = (hashes.select(places.alias("p")).groupBy(F.shiftright("p", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("bits")).toPandas())
    out = np.zeros((1 << width) // 64, "<i8")
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return Bitmap(out.tobytes())


LEAD, TAIL = 1, 2  # bits of ``edge``: the window's first, last token is a slot
_SCHEMA = "form string, hash long, pos int, slots array<string>, n int, edge int, words int"


def _inside(a: list[str], b: list[str], left: bool, right: bool) -> tuple[list[str], list[str]]:
    """The parts of two runs that both hold inside a passage that begins (``left``) or ends (``right``) within them."""
    k = min(len(a), len(b))
    if left and right:
        short, long = (a, b) if len(a) == k else (b, a)
        return (short, short) if any(long[i : i + k] == short for i in range(len(long) - k + 1)) else (a, b)
    return (a[-k:], b[-k:]) if left else (a[:k], b[:k])


def consistent(found: list[dict]) -> tuple[list[int], bool]:
    """(item positions of the windows of one diagonal that count, whether all windows' slots are equal)."""
    at = {w["item_pos"] for w in found}
    votes: dict[str, Counter] = defaultdict(Counter)
    pairs: list[list[tuple[str, set[str], bool]]] = []
    for w in found:
        own, last = [], len(w["slots"]) - 1
        for j, (a, b) in enumerate(zip(w["item_slots"], w["slots"])):
            a, b = a.lower(), b.lower()
            left = j == 0 and w["edge"] & LEAD and w["item_pos"] - 1 not in at
            right = j == last and w["edge"] & TAIL and w["item_pos"] + 1 not in at
            options, equal = {b}, a == b
            if not equal and (left or right):
                x, y = _inside(a.split(" "), b.split(" "), bool(left), bool(right))
                options, equal = {b, " ".join(y)}, x == y
            votes[a].update([a] if equal else options)
            own.append((a, options, equal))
        pairs.append(own)
    # of values that are as frequent, the item's own and then the smallest
    most = {a: min(c, key=lambda b: (-c[b], b != a, b)) for a, c in votes.items()}
    kept = [w["item_pos"] for w, own in zip(found, pairs)
            if all(equal for _, _, equal in own) or all(most[a] in options or (equal and most[a] == a) for a, options, equal in own)]
    return kept, all(equal for own in pairs for _, _, equal in own)


def windows(texts: DataFrame, wanted=None, once: bool = False, phrases: tuple[int, ...] = ()) -> DataFrame:
    """(id, key, form, hash, pos, slots, n, edge, words) of all windows, or of those that ``wanted`` (a broadcast Bitmap) may hold.

    ``once``: each distinct window of a text one time; n: how many distinct windows it has; a text of fewer
    than five tokens is also a phrase of so many words.  ``phrases``: lengths of phrases to give from every place.
    """
    prepare(texts.sparkSession)
    src = texts.select("id", "key", "text")
    schema = f"id {src.schema['id'].dataType.simpleString()}, key long, {_SCHEMA}"
    kinds = (pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.string()), pa.int32(), pa.int32(), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = wanted.value if wanted is not None else None
        for part in (p for batch in batches for p in slices(batch, "text", 500_000)):
            split = [tokens(t) for t in part.column(2).cast(pa.binary()).to_pylist()]
            rows = list(_rows(split, held, once, phrases))
            if rows:
                of, *columns = (pa.array(c, t) for c, t in zip(zip(*rows), kinds))
                yield pa.RecordBatch.from_arrays([part.column(0).take(of), part.column(1).take(of), *columns],
                                                 names=["id", "key", *(f.split()[0] for f in _SCHEMA.split(", "))])

    return src.mapInArrow(run, schema)


def _rows(split: list[list[bytes]], held: Bitmap | None, once: bool, phrases: tuple[int, ...]) -> Iterator[tuple]:
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    words = [w for ws in split for w in ws]
    coded = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    begin = np.cumsum(sizes) - sizes

    def passing(hashes: np.ndarray) -> np.ndarray:
        return np.arange(len(hashes)) if held is None else held.may_hold(hashes)

    signed = lambda h: int(h.astype(np.int64))
    for form in FORMS if words else ():
        t = Template(coded, sizes, form)
        hashes, inside = t.windows(form)
        at = passing(hashes)
        at = at[inside[at]]
        if once:
            at = at[np.unique(np.stack([t.text[at], hashes[at].view(np.int64)]), axis=1, return_index=True)[1]]
            at.sort()
        counts = np.bincount(t.text[at], minlength=len(split))
        for p in at.tolist():
            k = int(t.text[p])
            edge = LEAD * (t.kind[p] != LITERAL) + TAIL * (t.kind[p + WINDOW - 1] != LITERAL)
            yield k, form, signed(hashes[p]), p - int(t.start[k]), t.slots(words, p, WINDOW), int(counts[k]), int(edge), 0
        tokens_of = np.diff(t.start)
        for k in np.flatnonzero((tokens_of > 0) & (tokens_of < WINDOW)).tolist():
            p, n = int(t.start[k]), int(tokens_of[k])
            h = t.whole(k, form, coded)
            if len(passing(np.array([h]))):
                edge = LEAD * (t.kind[p] != LITERAL) + TAIL * (t.kind[p + n - 1] != LITERAL)
                yield k, form, signed(h), 0, t.slots(words, p, n), 1, int(edge), 0
            if once:
                own = coded[begin[k] : begin[k] + sizes[k]]
                yield k, "words", signed(phrase_hashes(own, len(own))[0]), 0, [], 1, 0, len(own)
    for size in phrases:
        hashes = phrase_hashes(coded, size)
        for p in passing(hashes).tolist():
            k = int(np.searchsorted(begin, p, "right")) - 1
            if p + size <= begin[k] + sizes[k]:
                yield k, "words", signed(hashes[p]), p - int(begin[k]), [], 1, 0, size


def text_key(text_col: str = "text"):
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text") -> DataFrame:
    """(id, key, item_id, n_windows, n_hits, coverage, exact): every document and item that share a consistent passage.

    ``exact``: all slot values are equal; the better form is given.
    """
    item_rows = items.select(F.col(item_col).alias("id"), text_key(item_text_col).alias("key"), F.col(item_text_col).cast("string").alias("text"))
    item_windows = staged(windows(item_rows, once=True).distinct(), "item-windows").select(
        F.col("id").alias("item_id"), F.col("key").alias("item_key"), "form", "hash", F.col("pos").alias("item_pos"), F.col("slots").alias("item_slots"), "n", "edge", "words")
    wanted = items.sparkSession.sparkContext.broadcast(bitmap(item_windows.select("hash").distinct()))  # BITS_MOST bits at most
    # the lengths of items of fewer than five tokens: a number for each distinct length, not for each item
    lengths = tuple(sorted(r[0] for r in item_windows.where("form = 'words'").select("words").distinct().collect()))
    doc_rows = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    found = windows(doc_rows, wanted, phrases=lengths).drop("n", "edge", "words").join(small_side(item_windows), ["form", "hash"])
    # rows that repeat id and text give the same positions again: distinct
    found = found.select("id", "key", "item_id", "item_key", "form", "n", "edge", "pos", "item_pos", "slots", "item_slots").distinct()
    by_diagonal = found.groupBy("id", "key", "item_id", "item_key", "form", "n", (F.col("pos") - F.col("item_pos")).alias("diagonal"))

    @F.arrow_udf("hits array<int>, equal boolean")
    def judged(found: pa.Array) -> pa.Array:
        return pa.array([dict(zip(("hits", "equal"), consistent(w))) for w in found.to_pylist()],
                        pa.struct([("hits", pa.list_(pa.int32())), ("equal", pa.bool_())]))

    # a list holds at most the item's windows
    passages = by_diagonal.agg(F.collect_list(F.struct("item_pos", "edge", "item_slots", "slots")).alias("found"))
    # called nondeterministic so that the filter isn't pushed below it: that would judge twice, by two Python workers a task
    passages = passages.withColumn("kept", judged.asNondeterministic()("found")).select("*", "kept.hits", "kept.equal").where(F.size("hits") > 0)
    by_form = passages.groupBy("id", "key", "item_id", "item_key", "form", "n").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("n_hits"), F.min("equal").alias("exact"))
    best = by_form.withColumn("coverage", F.col("n_hits") / F.col("n")).groupBy("id", "key", "item_id", "item_key").agg(
        F.max(F.struct("coverage", "exact", F.col("n_hits"), F.col("n").alias("n_windows"))).alias("b"))
    return best.select(F.col("id").alias(id_col), "key", F.col("item_id").alias(item_col), "b.n_windows", "b.n_hits", "b.coverage", "b.exact")


def contaminated(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, **columns) -> DataFrame:
    """The matches that cover an item."""
    return matches(docs, items, **columns).where(F.col("coverage") >= coverage)

"""Language-model scores by context-tree weighting over bytes (operator 1).

Text: A-Z lower-cased, words [^\\x20\\x09-\\x0D]+ joined by one space, then one end.
Every byte is eight binary decisions; a decision's node is the bits read so far,
its contexts are the last 0 .. DEPTH bytes (before a text: ends).  For every
context and node the training texts give two counts with the Krichevsky-Trofimov
block probability Pe.  From the deepest contexts up, Pw = 1/2 Pe + 1/2 prod Pw of
the contexts one byte longer; a decision is then predicted by mixing the KT
estimates of all depths, each with its share 1/2 Pe / Pw of what the shorter
contexts leave.  Where the next longer context was not seen in training, the
longest seen one takes the rest.

Blocks of distinct texts send each distinct (DEPTH + 1)-gram once, with its training
count, to a bucket of the last three context bytes; a bucket adds the counts up,
weights its own subtree and returns the log probability of each gram to the block
that asked, where texts are summed; staged once, the buckets are read twice.  Contexts of up to two bytes are weighted from
the buckets' sums: at most 65,536 contexts of 255 nodes, whatever the input.  Words
(as 64-bit hashes) are counted and returned the same way, so no count table is ever
broadcast.

Base: sum over words and the end of log10((c + 0.1) / (N + 0.1 (V + 1))).  Null and
empty texts are the end alone.  Equal texts are scored once and count as often as
they occur; repeated rows and null ids keep their rows; other columns are not read;
an empty table gives no rows, and with no training texts every bit costs one bit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions_for, staged
from tidemark.llm.text_blocks import Words, blocks, expand, expand_sorted, slices_of, squeeze, squeeze_sorted, texts_of
from tidemark.session import small_side

DEPTH = 5
LOW = 2  # contexts up to this many bytes are weighted in one place
BLOCK_BYTES = 12_000_000
BUCKET_BYTES = 12_000_000
END = 0x0A
_HALF = math.log(0.5)


def grams(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, Words]:
    """The gram of every byte of each text in its compact form, how many each text has, and the texts' words."""
    words = Words(texts, END)
    data, sizes = words.compact()
    padded = np.concatenate([np.full(depth, END, np.uint8), data]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for i in range(depth + 1):
        out = (out << np.uint64(8)) | padded[i : i + len(data)]
    # before a text's first byte stand ends, not the text before
    starts = np.cumsum(sizes) - sizes
    pad = int.from_bytes(bytes([END]) * depth, "big")
    for i in range(depth):
        at = starts[sizes > i] + i
        low = 8 * (i + 1)
        ends = np.uint64((pad << low) & ((1 << 8 * (depth + 1)) - 1))
        out[at] = (out[at] & np.uint64((1 << low) - 1)) | ends
    return out, sizes, words


def log_gamma(z: np.ndarray) -> np.ndarray:
    """Stirling's series at z + 8."""
    product = np.ones_like(z)
    for i in range(8):
        product = product * (z + i)
    y = z + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) - np.log(product)


def log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log block probability of a zeros and b ones."""
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - math.log(math.pi)


def _summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    own, inverse = np.unique(keys, return_inverse=True)
    return own, *(np.bincount(inverse, v, len(own)) for v in values)


def _decisions(g: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(key of context and node, bit) of the eight decisions of each gram, in rows of eight."""
    x = (g & np.uint64(255))[:, None]
    k = np.arange(8, dtype=np.uint64)[None]
    node = (np.uint64(1) << k) | (x >> (np.uint64(8) - k))
    context = (g >> np.uint64(8)) & np.uint64((1 << 8 * depth) - 1)
    return (context[:, None] << np.uint64(8)) | node, (x >> (np.uint64(7) - k)) & np.uint64(1)


class Tree:
    """Weights of the contexts of ``low`` .. ``high`` bytes."""

    def __init__(self):
        self.levels: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def add(self, depth: int, keys, a, b, below, deepest: bool) -> np.ndarray:
        pe = log_kt(a, b)
        pw = pe if deepest else np.logaddexp(pe, below) + _HALF
        share = np.ones_like(pe) if deepest else np.exp(_HALF + pe - pw)
        self.levels[depth] = (keys, (b + 0.5) / (a + b + 1.0), share)
        return pw

    def mix(self, depth: int, keys: np.ndarray, done: np.ndarray, rest: np.ndarray, last: np.ndarray, seen: np.ndarray) -> None:
        """Take one depth into the running mixture, in place."""
        own, p, share = self.levels[depth]
        if not len(own):
            seen[:] = False
            return
        at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
        seen &= own[at] == keys
        at = at[seen]
        done[seen] += rest[seen] * share[at] * p[at]
        rest[seen] *= 1 - share[at]
        last[seen] = p[at]


def upper_tree(g: np.ndarray, n: np.ndarray, depth: int = DEPTH, low: int = LOW) -> tuple[Tree, tuple[np.ndarray, ...]]:
    """Tree of the contexts longer than ``low`` from distinct grams; and (key, a, b, sum of log Pw) at ``low``."""
    tree = Tree()
    keys, bit = _decisions(g, depth)
    times = np.repeat(n.astype(np.float64), 8)
    ones = times * bit.reshape(-1)
    keys, a, b = _summed(keys.reshape(-1), times - ones, ones)
    below = np.zeros(len(keys))
    for d in range(depth, low, -1):
        pw = tree.add(d, keys, a, b, below, d == depth)
        parent = ((keys >> np.uint64(8)) & np.uint64((1 << 8 * (d - 1)) - 1)) << np.uint64(8) | (keys & np.uint64(255))
        keys, a, b, below = _summed(parent, a, b, pw)
    return tree, (keys, a, b, below)


def lower_tree(keys, a, b, below, low: int = LOW) -> Tree:
    tree = Tree()
    for d in range(low, -1, -1):
        pw = tree.add(d, keys, a, b, below, False)
        if d:
            parent = ((keys >> np.uint64(8)) & np.uint64((1 << 8 * (d - 1)) - 1)) << np.uint64(8) | (keys & np.uint64(255))
            keys, a, b, below = _summed(parent, a, b, pw)
    return tree


def log10_probabilities(g: np.ndarray, lower: Tree, upper: Tree, depth: int = DEPTH, low: int = LOW) -> np.ndarray:
    """Log10 probability of each gram's last byte after its context."""
    _, bit = _decisions(g, depth)
    size = len(g) * 8
    done, rest, last, seen = np.zeros(size), np.ones(size), np.full(size, 0.5), np.ones(size, bool)
    for d in range(depth + 1):
        (lower if d <= low else upper).mix(d, _decisions(g, d)[0].reshape(-1), done, rest, last, seen)
    one = np.clip(done + rest * last, 1e-300, 1.0)
    p = np.where(bit.reshape(-1) == 1, one, np.maximum(1 - one, 1e-300))
    return np.log10(p).reshape(-1, 8).sum(axis=1)


# ------------------------------------------------------------------ blocks and buckets

GRAM, WORD = 0, 1
SENT = "kind int, bucket long, block long, items binary, counts binary"
HELD = "kind int, bucket long, items binary, counts binary, n long, distinct long, blocks array<long>, asked array<binary>"


def _bucket_of(kind: int, keys: np.ndarray, n: int) -> np.ndarray:
    """Grams go by the last three bytes of their context, words by their hash."""
    if kind == GRAM:
        keys = ((keys >> np.uint64(8)) & np.uint64(0xFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
    return ((keys >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def _added(keys: np.ndarray, counts: np.ndarray, own: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(own)
    own, weights = own[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])[: len(own)])
    if not len(first):
        return keys, counts
    merged, inverse = np.unique(np.concatenate([keys, own[first]]), return_inverse=True)
    return merged, np.bincount(inverse, np.concatenate([counts, np.add.reduceat(weights, first)]), len(merged)).astype(np.int64)


def _send(part: pd.DataFrame, n_buckets: int, depth: int) -> pd.DataFrame:
    block = int(part["block"].iloc[0])
    _, texts, weights = texts_of(part["payload"])
    held = {kind: (np.zeros(0, np.uint64), np.zeros(0, np.int64)) for kind in (GRAM, WORD)}
    for at, run in slices_of(texts):
        w = weights[at : at + len(run)]
        own, sizes, words = grams(run, depth)
        held[GRAM] = _added(*held[GRAM], own, np.repeat(w, sizes))
        held[WORD] = _added(*held[WORD], words.hashes, np.repeat(w, words.counts))
    rows = []
    for kind, (keys, counts) in held.items():
        bucket = _bucket_of(kind, keys, n_buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        rows += [(kind, b, block, squeeze_sorted(keys[order[i:j]]), squeeze(counts[order[i:j]]))
                 for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]
    return pd.DataFrame(rows, columns=["kind", "bucket", "block", "items", "counts"])


def _hold(part: pd.DataFrame) -> pd.DataFrame:
    """One row for a bucket: its keys with their counts, and what each block asked for."""
    asked = [expand_sorted(i) for i in part["items"]]
    keys, total = _summed(np.concatenate(asked), np.concatenate([expand(c) for c in part["counts"]]).astype(np.int64))
    total = total.astype(np.int64)
    return pd.DataFrame([(part["kind"].iloc[0], part["bucket"].iloc[0], squeeze_sorted(keys), squeeze(total), int(total.sum()),
                          int((total > 0).sum()), part["block"].tolist(), part["items"].tolist())],
                        columns=["kind", "bucket", "items", "counts", "n", "distinct", "blocks", "asked"])


def _upper(items: bytes, counts: bytes, depth: int):
    keys, n = expand_sorted(items), expand(counts).astype(np.int64)
    return keys, *upper_tree(keys[n > 0], n[n > 0], depth)


def _low_sums(held: DataFrame, depth: int) -> DataFrame:
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for items, counts in zip(part["items"], part["counts"]):
                _, _, (at, a, b, below) = _upper(items, counts, depth)
                yield pd.DataFrame({"key": at.astype(np.int64), "a": a, "b": b, "below": below})

    each = held.where(F.col("kind") == GRAM).select("items", "counts").mapInPandas(run, "key long, a double, b double, below double")
    return each.groupBy("key").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("below").alias("below"))


def _values(held: DataFrame, lower, depth: int) -> DataFrame:
    """(kind, block, items, vals): the log probabilities of a block's grams, or the counts of its words."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for kind, items, counts, blocks_, asked in zip(part["kind"], part["items"], part["counts"], part["blocks"], part["asked"]):
                if kind == GRAM:
                    keys, upper, _ = _upper(items, counts, depth)
                    tree = lower_tree(*lower.value)
                    value = np.concatenate([log10_probabilities(k, tree, upper, depth) for k in np.array_split(keys, len(keys) // 50_000 + 1)])
                    packed = lambda at: value[at].astype("<f8").tobytes()  # noqa: E731, B023
                else:
                    keys, value = expand_sorted(items), expand(counts)
                    packed = lambda at: squeeze(value[at])  # noqa: E731, B023
                out = [packed(np.searchsorted(keys, expand_sorted(a))) for a in asked]
                yield pd.DataFrame({"kind": kind, "block": blocks_, "items": list(asked), "vals": out})

    return held.mapInPandas(run, "kind int, block long, items binary, vals binary")


def _gathered(back: pd.DataFrame, kind: int) -> tuple[np.ndarray, np.ndarray]:
    own = back[back["kind"] == kind]
    keys = np.concatenate([np.zeros(0, np.uint64), *(expand_sorted(i) for i in own["items"])])
    read = (lambda v: np.frombuffer(v, "<f8")) if kind == GRAM else (lambda v: expand(v).astype(np.float64))
    value = np.concatenate([np.zeros(0), *(read(v) for v in own["vals"])])
    order = np.argsort(keys)
    return keys[order], value[order]


def _looked_up(own: np.ndarray, keys: np.ndarray, value: np.ndarray) -> np.ndarray:
    order = np.argsort(own)
    ranked = own[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])[: len(ranked)])
    out = np.empty(len(own))
    out[order] = np.repeat(value[np.searchsorted(keys, ranked[first])], np.diff(np.append(first, len(own))))
    return out


def _per_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    ends = np.cumsum(counts)
    whole = counts > 0
    out = np.zeros(len(counts))
    if len(values):
        out[whole] = np.add.reduceat(values, (ends - counts)[whole])
    return out


def _score(part: pd.DataFrame, back: pd.DataFrame, n_total: int, distinct: int, ends: int, depth: int) -> pd.DataFrame:
    shas, texts, _ = texts_of(part["payload"])
    gram, word = _gathered(back, GRAM), _gathered(back, WORD)
    below = math.log10(n_total + 0.1 * (distinct + 1))
    out = []
    for at, run in slices_of(texts):
        own, sizes, words = grams(run, depth)
        c = _looked_up(words.hashes, *word)
        base = _per_text(np.log10(c + 0.1) - below, words.counts) + math.log10(ends + 0.1) - below
        out.append(pd.DataFrame({
            "sha": shas[at : at + len(run)], "n_tokens": words.counts + 1, "n_known": _per_text(c > 0, words.counts).astype(np.int64) + (ends > 0),
            "base_score": base, "score": _per_text(_looked_up(own, *gram), sizes), "n_bytes": sizes}))
    return pd.concat(out)


def scored(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
           block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(id, is_training, n_tokens, n_known, train_tokens, base_score, score, n_bytes, bits_per_byte), one row per document."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(training, F.lit(False)).alias("is_training"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sums = rows.agg(F.sum(F.octet_length("text")), F.sum(F.col("is_training").cast("long"))).first()
    total, ends = sums[0] or 0, sums[1] or 0
    n_blocks, n_buckets = partitions_for(total, block_bytes), partitions_for(total, bucket_bytes)
    dealt = blocks(rows.select("text", F.col("is_training").cast("long").alias("weight")), n_blocks)

    sent = dealt.groupBy("block").applyInPandas(lambda p: _send(p, n_buckets, depth), SENT)
    held = staged(sent.groupBy("kind", "bucket").applyInPandas(_hold, HELD), "counted")
    # contexts of two bytes: at most 65,536 x 255 rows
    low = _low_sums(held, depth).orderBy("key").toPandas()
    lower = docs.sparkSession.sparkContext.broadcast(
        (low["key"].to_numpy().astype(np.uint64), *(low[c].to_numpy(float) for c in ("a", "b", "below"))))
    words = held.where(F.col("kind") == WORD).agg(F.sum("n"), F.sum("distinct")).first()
    n_total, distinct = (words[0] or 0) + ends, (words[1] or 0) + (ends > 0)

    known = dealt.groupBy("block").cogroup(_values(held, lower, depth).groupBy("block")).applyInPandas(
        lambda p, b: _score(p, b, n_total, distinct, ends, depth), "sha string, n_tokens long, n_known long, base_score double, score double, n_bytes long")
    known = staged(known, "scores")
    out = rows.select("id", "is_training", F.sha2("text", 256).alias("sha")).join(small_side(known), "sha")
    return out.select(F.col("id").alias(id_col), "is_training", "n_tokens", "n_known", F.lit(n_total).cast("long").alias("train_tokens"),
                      "base_score", "score", "n_bytes", (-F.col("score") / math.log10(2) / F.col("n_bytes")).alias("bits_per_byte"))

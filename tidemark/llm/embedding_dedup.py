"""Embedding near-duplicates by spherical k-means cells (operator 5).

Rows with equal label and vector are one class, so copies are compared once.
Unit centroids are fitted on a bounded sample; their number is the one by which the
sample's cells promise the least work.  They only deal out the work, the links are
exact: two unit vectors with cosine >= t are at most r = sqrt(2 - 2t)
apart, so a vector x of cell i is also sent to every cell j < i whose border is
within r, that is x.(c_i - c_j) <= r |c_i - c_j|.  A pair across cells is then
compared in the lower cell, once.  A vector is stored once for every cell it goes to, in
packed blocks; every two blocks of a cell meet in a nested loop over those files, so disk
grows with the vectors and only reading and comparing with their pairs.  A task returns
each vector's links and a star of each component it saw, never the pairs.

Vectors that are null, empty, zero or hold a null or non-finite component, and
rows with a null label, link with nothing.  Vectors of different lengths don't
link.  Repeated rows are other vectors of one class; a null id is larger than any
other.  Empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.block_pairs import BlockCache, block_pairs, least_roots, spread_roots
from tidemark.llm.common import batch_rows, staged
from tidemark.llm.components import components
from tidemark.session import small_side

THRESHOLD = 0.98
SAMPLE = 20_000  # vectors that centroids are fitted on
CELLS = (2, 4, 16, 64, 256, 1024, 4096)  # numbers of centroids to choose from: two at least
BLOCK = 2000  # vectors of a cell in one packed block
COPIES = 2  # times that cells may store a vector, on average: at most this many, whatever they would save
HOLD_BYTES = 32_000_000  # vectors that a task holds before it packs blocks that aren't full
ROW_COST, PAIR_COST = 10e-6, 20e-9  # seconds to send a vector, to compare a pair
CHUNK = 250  # vectors of a block that are multiplied with another at once
FOUND = 200_000  # linked vectors that a task holds before it adds them up


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _runs(n: int, step: int = 2000):
    return (slice(i, i + step) for i in range(0, n, step))


def fit_centroids(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means: centroids are renormalised means; an empty cell keeps its centroid."""
    x = unit(x)
    c = x[np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        home = np.concatenate([(x[r] @ c.T).argmax(axis=1) for r in _runs(len(x))])
        sums = np.zeros_like(c)
        np.add.at(sums, home, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), c)
    return c


def _cells(x: np.ndarray, c: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Run by run of ``x``: home cell of each vector, and which lower cells have a border near enough."""
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    gap = np.sqrt(np.maximum(0, (c * c).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None] - 2 * c @ c.T)) + 1e-7
    for r in _runs(len(x)):
        s = unit(x[r]) @ c.T
        home = s.argmax(axis=1)
        near = s[np.arange(len(s)), home][:, None] - s <= reach * gap[home] + 1e-9
        near &= np.arange(len(c))[None] < home[:, None]
        yield home, near


def cells_of(x: np.ndarray, c: np.ndarray, threshold: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Home cell of each vector, and the lower cells whose border is near enough."""
    homes, others = [], []
    for home, near in _cells(x, c, threshold):
        homes.append(home)
        others += [np.flatnonzero(row) for row in near]
    return np.concatenate(homes) if homes else np.zeros(0, int), others


def expected_cost(x: np.ndarray, labels: np.ndarray, c: np.ndarray, threshold: float, times: float) -> float:
    """Seconds that comparing within the cells of centroids ``c`` would take, for ``times`` as many vectors as ``x``.

    Centroids by which a vector would be stored more than COPIES times are out of the question."""
    names, label = np.unique(labels, return_inverse=True)
    rows, at = np.zeros((len(names), len(c))), 0
    for home, near in _cells(x, c, threshold):
        own = label[at : at + len(home)]
        np.add.at(rows, (own, home), 1)
        for k in np.unique(own):
            rows[k] += near[own == k].sum(axis=0)
        at += len(home)
    if rows.sum() > COPIES * len(x):
        return float("inf")
    rows = rows * times
    return float((ROW_COST * rows * np.ceil(rows / BLOCK) + PAIR_COST * rows * rows / 2).sum())


def chosen_centroids(x: np.ndarray, labels: np.ndarray, threshold: float, times: float) -> np.ndarray:
    """The centroids of the least expected cost; always more than one for eight vectors or more, and more of
    them the more clusters the vectors fall into (elsewhere border copies outweigh the cells)."""
    options = [fit_centroids(x, k) for k in CELLS if k <= len(x) // 4] or [fit_centroids(x, 1)]
    return min(options, key=lambda c: expected_cost(x, labels, c, threshold, times))


def pack_block(cid: np.ndarray, n: np.ndarray, own: np.ndarray, x: np.ndarray) -> bytes:
    """Classes, their numbers of rows, whether they live in the cell, and their vectors."""
    return cid.astype("<i8").tobytes() + n.astype("<i8").tobytes() + own.astype(bool).tobytes() + x.tobytes()


class Block:
    """A packed block of vectors of ``size`` components of type ``kind``."""

    def __init__(self, data: bytes, size: int, kind: str):
        m = len(data) // (17 + size * np.dtype(kind).itemsize)
        self.cid, self.n = np.frombuffer(data, "<i8", m), np.frombuffer(data, "<i8", m, 8 * m)
        self.own = np.frombuffer(data, bool, m, 16 * m)
        self.x = np.frombuffer(data, kind, m * size, 17 * m).reshape(m, size)
        x = self.x.astype(float)
        self.norms = np.sqrt((x * x).sum(axis=1))
        fair = np.isfinite(self.norms) & (self.norms > 0)  # others link with nothing
        self.short = np.divide(x, self.norms[:, None], out=np.zeros_like(x), where=fair[:, None]).astype(np.float32)


def block_links(a: Block, b: Block, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cid, links, root) of the classes linked between two blocks, or within one that meets itself; a class may come several times.

    Single precision tells the pairs that are clearly linked or clearly not, the others are multiplied in double."""
    same, size = a is b, a.x.shape[1]
    unsure = 4 * (size + 8) * float(np.finfo(np.float32).eps)
    both, rows = np.concatenate([a.own, b.own]).all(), []
    n_b, root_b, links_b = b.n.astype(float), b.cid.copy(), np.zeros(len(b.cid))
    for at in range(0, len(a.cid), CHUNK):
        r = slice(at, at + CHUNK)
        s = a.short[r] @ b.short.T
        near = s >= threshold - unsure
        if same:
            i = np.arange(len(near))
            near[i, i + at] = False
        if not near.any():
            continue
        i, j = np.nonzero(near & (s <= threshold + unsure))
        for k in _runs(len(i)):
            u, v = i[k] + at, j[k]
            near[i[k], v] = (a.x[u].astype(float) * b.x[v]).sum(axis=1) / a.norms[u] / b.norms[v] >= threshold
        if not both:  # two guests of a cell are compared where one of them is at home
            near &= a.own[r][:, None] | b.own[None]
        used = np.flatnonzero(near.any(axis=0))
        if not len(used):
            continue
        mine = np.flatnonzero(near.any(axis=1))
        near = near[np.ix_(mine, used)]
        links, root, other = near @ n_b[used], a.cid[r][mine], root_b[used]
        if not same:
            links_b[used] += a.n[r][mine].astype(float) @ near
        root, other = spread_roots(near, root, other)
        # where an earlier chunk had given a class of b another root, the two are one component
        before = root_b[used]
        rows += [(a.cid[r][mine], links, root), (before, np.zeros(len(before)), other)]
        root_b[used] = other
    moved = (links_b > 0) | (root_b != b.cid)
    rows.append((b.cid[moved], links_b[moved], root_b[moved]))
    cid, links, root = (np.concatenate(c) for c in zip(*rows))
    return cid, np.rint(links).astype(np.int64), root


def _added(found: list[tuple]) -> list[tuple]:
    """One row for each class: all its links, and the least class that it is connected with."""
    if not found:
        return []
    cid, links, root = (np.concatenate(c) for c in zip(*found))
    names, roots = least_roots(cid, root)
    total = np.zeros(len(names), np.int64)
    np.add.at(total, np.searchsorted(names, cid), links)
    return [(names, total, roots)]


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", sample: int = SAMPLE) -> DataFrame:
    """(id, n_links, component_id, kept), one row per vector."""
    kind = "float" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast(f"array<{kind}>").alias("x"))
    good = (F.col("label").isNotNull() & F.col("x").isNotNull()
            & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0))
    # equal vectors by a digest of their digits, so that no join carries vectors; 0 and -0 are equal
    digits = F.transform("x", lambda v: F.when(v == 0, F.lit(0).cast(kind)).otherwise(v)).cast("string")
    keyed = rows.withColumn("key", F.when(good, F.unhex(F.sha2(digits, 256))))
    classes = (keyed.where("key IS NOT NULL").groupBy("label", "key").agg(F.count("*").alias("n"), F.min("id").alias("rep"), F.first("x").alias("x"))
               .withColumns({"cid": F.monotonically_increasing_id(), "kind": F.col("label").cast("string")}))
    classes = staged(classes, "classes")
    total = classes.count()

    picked = classes.orderBy(F.xxhash64("cid"), "cid").limit(sample).select("kind", "x").toPandas()  # bounded by ``sample``
    centroids = {}
    for size, own in picked.groupby(picked["x"].map(len)):
        centroids[size] = chosen_centroids(np.array(own["x"].tolist(), float), pd.factorize(own["kind"])[0], threshold, total / len(picked))

    code = "<f4" if kind == "float" else "<f8"

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}  # a cell's rows, and how many they are
        used = 0

        def packed(cells: list[tuple]) -> pa.RecordBatch:
            out = []
            for cell in cells:
                cid, n, own, x = (np.concatenate(c) for c in zip(*held.pop(cell)[0]))
                out += [(*cell, pack_block(cid[i : i + BLOCK], n[i : i + BLOCK], own[i : i + BLOCK], x[i : i + BLOCK])) for i in range(0, len(cid), BLOCK)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.int64(), pa.binary()))],
                                              names=["kind", "size", "cell", "payload"])

        for batch in batches:
            labels, cids, ns = np.array(batch["kind"].to_pylist(), object), batch["cid"].to_numpy(), batch["n"].to_numpy()
            lengths, flat = batch["x"].value_lengths().to_numpy(), batch["x"].flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(lengths) - lengths
            for size in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == size)
                x = flat[starts[rows][:, None] + np.arange(size)[None]].astype(code)
                home, others = cells_of(x.astype(float), centroids[size], threshold) if size in centroids else (np.zeros(len(x), int), [[]] * len(x))
                at = np.repeat(np.arange(len(x)), [1 + len(o) for o in others])
                cell = np.concatenate([[h, *o] for h, o in zip(home, others)])
                names, label = np.unique(labels[rows], return_inverse=True)
                _, first, group = np.unique(np.stack([label[at], cell]).astype(np.int64), axis=1, return_index=True, return_inverse=True)
                order = np.argsort(group.reshape(-1), kind="stable")
                for part in np.split(order, np.cumsum(np.bincount(group.reshape(-1)))[:-1]):
                    i = at[part]
                    key = (names[label[i[0]]], size, int(cell[part[0]]))
                    own = held.setdefault(key, [[], 0])
                    own[0].append((cids[rows[i]], ns[rows[i]], home[i] == key[2], x[i]))
                    own[1] += len(i)
                    used += x[i].nbytes
                    if own[1] >= BLOCK:
                        used -= own[1] * x.itemsize * size
                        yield packed([key])
            if used > HOLD_BYTES:
                largest = sorted(held, key=lambda k: -held[k][1])[: len(held) // 2 + 1]
                used -= sum(held[k][1] * np.dtype(code).itemsize * k[1] for k in largest)
                for k in largest:
                    yield packed([k])
        for k in list(held):
            yield packed([k])

    dealt = classes.select("kind", "cid", "n", "x").mapInArrow(deal, "kind string, size int, cell long, payload binary")
    dealt = staged(dealt.withColumn("block", F.monotonically_increasing_id()), "cells")
    pairs = block_pairs(dealt, ["kind", "size", "cell"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, found, many = BlockCache(), [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found[0]], names=["cid", "links", "root"])

        for batch in batches:
            for k in range(batch.num_rows):
                size = batch["a_size"][k].as_py()
                a, b = cache.two(batch, k, lambda data: Block(data, size, code))
                new = block_links(a, b, threshold)
                if len(new[0]):
                    found.append(new)
                    many += len(new[0])
            if many > FOUND:
                found = _added(found)
                many = 0
                if len(found[0][0]) > FOUND:
                    yield out()
                    found = []
        found = _added(found)
        if found:
            yield out()

    with batch_rows(vectors.sparkSession, 4):
        found = staged(pairs.mapInArrow(compare, "cid long, links long, root long"), "links")
    linked = components(found.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    linked = staged(linked, "linked")
    others = staged(found.groupBy("cid").agg(F.sum("links").alias("links")), "counts")
    reps = classes.select("cid", "rep", "n", "label", "key").join(linked.withColumnRenamed("node", "cid"), "cid", "left").join(others, "cid", "left")
    reps = staged(reps.withColumn("component", F.coalesce("component", "cid")), "reps")
    least = staged(reps.groupBy("component").agg(F.min("rep").alias("component_id")), "least")
    done = staged(reps.join(small_side(least), "component").select(
        "label", "key", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "done")
    out = keyed.select("id", "label", "key").join(done, ["label", "key"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))

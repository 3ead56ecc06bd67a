"""Merkle manifest of a dataset as a postorder append log (operator 13).

Every row is a leaf: the SHA-256 (lower-case hex) of its columns, each ``-`` if null and
else its length in UTF-8 bytes, a colon and its value.  Leaves of one tree (a language)
ascend by id; every eight neighbours are hashed together until one node is left, the
tree's root, and the roots ordered by their tree (null first) form the top tree.

Rows get their place in their tree by a range sort and counts per range, so a tree may
hold any share of the rows.  Aligned builders each take 8^LEVELS neighbours (bounded,
whatever a tree's size) and append nodes in the order of their completion: a node follows
the last leaf below it at once.  Builders' roots are the next round's children, so a
round hashes 1/512 of the one before.  Node j of level l in a tree of n leaves, whose
last leaf is e - 1 = min((j + 1) 8^l, n) - 1, stands at

    e - 1 + floor((e - 1) / 8) + floor((e - 1) / 64) + ... + l

in its tree's log, a closed form of the subtrees completed before it.  Builders' runs of
the log and proof extraction find siblings by it, without an index or a search.  Upper
siblings are joined once a builder, not once a row.

Null ids come first and count as the empty text in ``crc32``; repeated ids are ordered
by their leaf, and rows that repeat every column are leaves of their own.  Null and empty texts
differ (``-`` and ``0:``); texts are hashed whole; other columns are not read, unless
named in ``columns``; an empty table has no leaves and no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, staged
from tidemark.session import small_side

WIDTH = 8  # children of a node
LEVELS = 3  # levels that one builder completes
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


# ------------------------------------------------------------------ closed forms

def nodes_on(level: int, n: int) -> int:
    """Nodes of a level above ``n`` leaves."""
    return -(-n // WIDTH**level)


def height(n: int) -> int:
    levels = 0
    while nodes_on(levels, n) > 1:
        levels += 1
    return levels


def position(level: int, index: int, n: int) -> int:
    """Where a node stands in the postorder log of a tree of ``n`` leaves."""
    last = min((index + 1) * WIDTH**level, n) - 1
    at, rest = last + level, last // WIDTH
    while rest:
        at, rest = at + rest, rest // WIDTH
    return at


def sibling_positions(leaf: int, n: int, levels: int) -> list[int]:
    """Where the siblings of a leaf's path stand, level by level, left to right."""
    out = []
    for level in range(levels):
        own = leaf // WIDTH**level
        first = own - own % WIDTH
        out += [position(level, j, n) for j in range(first, min(first + WIDTH, nodes_on(level, n))) if j != own]
    return out


def siblings(leaf: int, n: int) -> int:
    """How many siblings a leaf's path has up to the root."""
    return sum(min(WIDTH, nodes_on(level, n) - leaf // WIDTH**level // WIDTH * WIDTH) - 1 for level in range(height(n)))


@lru_cache(64)
def _paths(n: int, levels: int) -> tuple[list[int], list[list[int]]]:
    """Positions of the leaves, and of the siblings of each, in a builder's part of the log."""
    return [position(0, i, n) for i in range(n)], [sibling_positions(i, n, levels) for i in range(n)]


def hashed(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def appended(children: list[str], levels: int) -> list[str]:
    """The log of ``levels`` levels above some neighbours: every node right after the last one below it."""
    log: list[str] = []
    waiting: list[list[str]] = [[] for _ in range(levels)]
    for i, digest in enumerate(children):
        log.append(digest)
        for run in waiting:
            run.append(digest)
            if len(run) < WIDTH and i + 1 < len(children):
                break
            digest = hashed("".join(run))
            run.clear()
            log.append(digest)
    return log


def folded(digest: str, proof: list[str], leaf: int, n: int) -> str:
    """The root above a leaf's digest and its siblings, level by level."""
    at = 0
    for level in range(height(n)):
        own = leaf // WIDTH**level
        first = own - own % WIDTH
        siblings = min(WIDTH, nodes_on(level, n) - first) - 1
        before = at + own - first
        digest = hashed("".join([*proof[at:before], digest, *proof[before : at + siblings]]))
        at += siblings
    return digest


def _hex(packed: bytes) -> list[str]:
    shown = packed.hex()
    return [shown[i : i + 64] for i in range(0, len(shown), 64)]


# ------------------------------------------------------------------ leaves and places

def leaf_digest(columns: list[Column]) -> Column:
    def shown(c: Column) -> Column:
        text = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*map(shown, columns)), 256)


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with their place in ``tree`` by ``order`` (pos, from 0) and the number of the tree's rows (n)."""
    dealt = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    # upper bits: the range; lower bits: the row in it
    dealt = staged(dealt.withColumn("__row", F.monotonically_increasing_id()), name).withColumn("__range", F.shiftright("__row", 33))
    spans = dealt.groupBy("tree", "__range").agg(F.min("__row").alias("__first"), (F.max("__row") - F.min("__row") + 1).alias("__rows"))
    before = Window.partitionBy("tree").orderBy("__range")  # one row a range
    spans = spans.withColumn("__before", F.sum("__rows").over(before) - F.col("__rows")).withColumn(
        "n", F.sum("__rows").over(Window.partitionBy("tree")))
    spans = small_side(staged(spans.select("tree", "__range", (F.col("__before") - F.col("__first")).alias("__shift"), "n"), f"{name}-spans"))
    return dealt.join(spans, ["tree", "__range"]).withColumn("pos", F.col("__row") + F.col("__shift")).drop("__row", "__range", "__shift")


# ------------------------------------------------------------------ builders

_BUILT = "tree string, seg long, n long, ids array<{kind}>, other binary, log binary, root string"


def _built(children: DataFrame, width: int, name: str) -> DataFrame:
    """One row a builder of (tree, id, digest, other, pos, n): its children's ids, its part of the log and its root."""
    kind = children.schema["id"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        tree, seg, n = (table.column(c)[0] for c in ("tree", "seg", "n"))
        levels = height(n.as_py()) if n.as_py() <= width else height(width)
        log = appended(table.column("digest").to_pylist(), levels)
        other = bytes.fromhex("".join(table.column("other").to_pylist()))
        ids = pa.concat_arrays(table.column("id").chunks)
        return pa.table({"tree": [tree], "seg": [seg], "n": [n], "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                         "other": pa.array([other], pa.binary()), "log": pa.array([bytes.fromhex("".join(log))], pa.binary()), "root": [log[-1]]})

    rows = children.withColumn("seg", F.floor(F.col("pos") / width)).select("tree", "seg", "n", "pos", "id", "digest", "other")
    return staged(rows.groupBy("tree", "seg").applyInArrow(run, _BUILT.format(kind=kind)), name)


class Forest:
    """The builders' rounds above numbered leaves (tree, id, digest, other, pos, n) of any number of trees.

    rounds[0] holds the leaves, rounds[r] the roots of the builders of round r - 1 of every tree
    that has more than one of them.
    """

    def __init__(self, leaves: DataFrame, name: str, levels: int = LEVELS):
        self.width = WIDTH**levels
        most = leaves.agg(F.max("n")).head()[0] or 0
        self.rounds: list[DataFrame] = [_built(leaves, self.width, f"{name}-0")]
        while most > self.width:
            most = -(-most // self.width)
            below = self.rounds[-1].where(F.col("n") > self.width)
            n = F.ceil(F.col("n") / self.width)
            up = below.select("tree", F.col("seg").alias("id"), F.col("root").alias("digest"), F.col("root").alias("other"), F.col("seg").alias("pos"), n.alias("n"))
            self.rounds.append(_built(up, self.width, f"{name}-{len(self.rounds)}"))

    def roots(self) -> DataFrame:
        """(tree, root) of every tree."""
        each = [r.where(F.col("n") <= self.width).select("tree", "root") for r in self.rounds]
        out = each[0]
        for more in each[1:]:
            out = out.unionByName(more)
        return out

    def log(self) -> DataFrame:
        """(tree, position, digests): the append log; digests are 32 bytes each, in postorder from ``position`` on.

        A builder above the leaves appends a few nodes at a time, right after the last of
        its children that each of them waits for.
        """
        width = self.width

        def run(batches: Iterator[pa.RecordBatch], r: int) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[tuple] = []
                for tree, seg, leaves, n, log, size in zip(*(c.to_pylist() for c in batch.columns)):
                    levels, below = height(n) if n <= width else height(width), r * height(width)
                    if not r:
                        out.append((tree, position(0, seg * width, leaves), log))
                        continue
                    for j in range(0, size, WIDTH):  # where the builder completed something: after each full run
                        last = min(j + WIDTH, size) - 1
                        at = position(0, last, size)
                        up = 1
                        while up < levels and (last + 1 == size or (last + 1) % WIDTH ** (up + 1) == 0):
                            up += 1
                        own = log[32 * (at + 1) : 32 * (at + 1 + up)]
                        out.append((tree, position(below + 1, (seg * width + last) // WIDTH, leaves), own))
                if out:
                    yield pa.RecordBatch.from_pydict({k: pa.array(v, t) for (k, t), v in zip(
                        (("tree", pa.string()), ("position", pa.int64()), ("digests", pa.binary())), zip(*out))})

        sizes = self.rounds[0].groupBy("tree").agg(F.max("n").alias("leaves"))
        out = None
        for r, rows in enumerate(self.rounds):
            src = rows.join(small_side(sizes), "tree").select("tree", "seg", "leaves", "n", "log", F.size("ids").alias("size"))
            part = src.mapInArrow(lambda b, r=r: run(b, r), "tree string, position long, digests binary")
            out = part if out is None else out.unionByName(part)
        return out

    def above(self, top: DataFrame) -> DataFrame:
        """(tree, seg, above, leaves and what ``top`` has): the siblings above each builder of round 0.

        ``top`` (tree, above, ..) has the siblings above each tree's root; all as 32 bytes each.
        """
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for tree, seg, n, size, log in zip(*(c.to_pylist() for c in batch.columns)):
                    paths = _paths(size, height(n) if n <= width else height(width))[1]
                    own = [b"".join(log[32 * p : 32 * p + 32] for p in path) for path in paths]
                    yield pa.RecordBatch.from_pydict({
                        "tree": pa.array([tree] * size), "parent": pa.array([seg] * size, pa.int64()),
                        "seg": pa.array(range(seg * width, seg * width + size), pa.int64()), "own": pa.array(own, pa.binary())})

        here = None
        for rows in reversed(self.rounds):
            done = rows.where(F.col("n") <= width).select("tree", "seg").join(small_side(top), "tree")
            here = done if here is None else done.unionByName(
                below.join(here.withColumnRenamed("seg", "parent"), ["tree", "parent"])
                .withColumn("above", F.concat("own", "above")).select(done.columns))
            below = (rows.select("tree", "seg", "n", F.size("ids").alias("size"), "log")
                     .mapInArrow(run, "tree string, parent long, seg long, own binary"))
        return here


# ------------------------------------------------------------------ manifest

def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", tree_col: str = "lang",
             changed: tuple[str, Column, Column] | None = None, levels: int = LEVELS) -> tuple[Forest, Forest]:
    """(the trees, the top tree) of all rows.

    ``changed`` (column, its other value, where): a second digest of each leaf with that value,
    which proofs are checked against.
    """
    prepare(docs.sparkSession)
    digest = leaf_digest([F.col(c) for c in columns])
    other = digest
    if changed:
        name, value, where = changed
        other = F.when(where, leaf_digest([value if c == name else F.col(c) for c in columns])).otherwise(digest)
    # one key a tree whose order is the trees': null first, then by bytes
    tree = F.when(F.col(tree_col).isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), F.col(tree_col).cast("string")))
    leaves = staged(docs.select(tree.alias("tree"), F.col(id_col).alias("id"), digest.alias("digest"), other.alias("other")), "leaves")
    trees = Forest(numbered(leaves, ["id", "digest"], "numbered"), "trees", levels)
    roots = staged(trees.roots().select(F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("root").alias("digest"), F.col("root").alias("other")), "roots")
    return trees, Forest(numbered(roots, ["id"], "numbered-roots"), "top", levels)


def proofs(trees: Forest, top: Forest, whole: bool = False) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row; ``whole``: and the proof itself.

    ``folded_root`` is what the row's other digest and the untampered siblings give.
    """
    # no tree is above the top tree: its siblings' list ends there
    ends = top.roots().select("tree", F.lit(b"").alias("above"), F.col("root"))
    subroots = _expanded(top, top.above(ends), "tree", ["root"]).select(
        F.col("id").alias("tree"), "above", F.col("digest").alias("subroot"), "root", F.col("pos").alias("tree_pos"), F.col("leaves").alias("n_trees"))
    subroots = staged(subroots, "subroots")
    keep = ["subroot", "root", "tree_pos", "n_trees"]
    joined = trees.rounds[0].drop("root").join(small_side(staged(trees.above(subroots), "upper-siblings")), ["tree", "seg"])
    width, kind = trees.width, joined.schema["ids"].dataType.elementType.simpleString()
    src = joined.select("seg", "n", "ids", "other", "log", "above", *keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)):
            seg, n, other, log, above, subroot, root, tree_pos, n_trees = (row.column(i)[0].as_py() for i in (0, 1, 3, 4, 5, 6, 7, 8, 9))
            ids = row.column(2).flatten()
            nodes, own, upper = _hex(log), _hex(other), _hex(above)
            places, paths = _paths(len(ids), height(n) if n <= width else height(width))
            n_upper = siblings(tree_pos, n_trees)
            out: list[tuple] = []
            for i, (place, path) in enumerate(zip(places, paths)):
                proof = [nodes[p] for p in path] + upper
                inner = len(proof) - n_upper
                up = folded(folded(own[i], proof[:inner], seg * width + i, n), proof[inner:], tree_pos, n_trees)
                out.append((nodes[place], subroot, root, hashed("".join(proof)), up, up == root, proof))
            digest, sub, top_root, sha, up, same, proof = zip(*out)
            columns = [ids, *map(pa.array, (digest, sub, top_root, sha, up, same))]
            names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
            if whole:
                columns.append(pa.array(proof, pa.list_(pa.string())))
                names.append("proof")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return src.mapInArrow(run, f"id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
                          + ", proof array<string>" * whole)


def _expanded(forest: Forest, above: DataFrame, name: str, keep: list[str]) -> DataFrame:
    """(id, digest, pos, leaves, above, ..): every leaf of a forest with all siblings above it."""
    width = forest.width
    src = forest.rounds[0].drop("root").join(small_side(above), ["tree", "seg"]).select("seg", "n", "ids", "log", "above", *keep)
    kept = ", ".join(f"{c} string" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)):
            seg, n, log, above = (row.column(i)[0].as_py() for i in (0, 1, 3, 4))
            ids = row.column(2).flatten()
            places, paths = _paths(len(ids), height(n) if n <= width else height(width))
            at = lambda p: log[32 * p : 32 * p + 32]
            yield pa.RecordBatch.from_pydict({
                "id": ids, "digest": [at(p).hex() for p in places], "pos": pa.array(range(seg * width, seg * width + len(ids)), pa.int64()),
                "leaves": pa.array([n] * len(ids), pa.int64()), "above": pa.array([b"".join(map(at, p)) + above for p in paths], pa.binary()),
                **{c: [row.column(5 + k)[0].as_py()] * len(ids) for k, c in enumerate(keep)}})

    kind = src.schema["ids"].dataType.elementType.simpleString()
    return src.mapInArrow(run, f"id {kind}, digest string, pos long, leaves long, above binary, {kept}")

"""Near-duplicate documents by a Jaccard metric-space join (operator 10).

Jaccard distance is a metric: a pair at similarity 0.75 or more is at most
D = 0.25 apart.  Pivots make Voronoi regions; a text of region i is also sent to
every region j < i with d(x, p_j) <= d(x, p_i) + 2D, which by the triangle
inequality holds every partner that lives there.  Regions are joined again with
pivots of their own until they are small, then compared exactly.

Unrelated texts share no shingle: all lie at distance 1 from all pivots, where no
metric can tell them apart.  So the first split is by what a pair within D must
share: of each set's shingles, rarest first, one of the first |x| - ceil(0.75|x|) + 1
is common to both (any order that is the same everywhere will do).  Texts that
share none are done; those that do are connected into the first regions, which
meet only inside.  Shingle frequencies are counted over all texts: blocks of texts
send each distinct shingle once to a bucket of the hash space, which answers how many
texts hold it.

Only components are asked for, so a region whose members are already connected is
done: in a dense group of near copies one round of pivots links nearly all, and the
rest is compared with blocks of the group.  Blocks of a wide region are written once and
meet in a nested loop over their files, so disk doesn't grow with a group's square.  No
pair list is ever formed, and every link between different texts counts.

Sets: A-Z lower-cased, words [^\\x20\\x09-\\x0D]+, distinct runs of five words (with
fewer words the whole sequence), as 64-bit hashes.  Null, empty and blank texts have
an empty set and link with nothing; equal texts count as one; repeated rows and null
ids keep their rows, a null id is larger than any other; other columns are not read;
empty tables give no rows.  Very long texts are one set like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.block_pairs import BlockCache, block_pairs, least_roots, spread_roots
from tidemark.llm.common import batch_rows, drop_shuffles, no_rows, partitions_for, staged
from tidemark.llm.components import components
from tidemark.llm.text_blocks import Words, blocks, expand, expand_sorted, mixed, release, slices_of, squeeze, squeeze_sorted, texts_of
from tidemark.session import small_side

WORDS = 5
PERCENT = 75
BLOCK_BYTES = 3_000_000
BUCKET_BYTES = 6_000_000
LEAF = 32  # texts a region may have to be compared at once; larger ones are divided by pivots
BLOCK = 256  # texts of two blocks that are compared with each other in one group
WIDE = 512  # texts of a region up to which blocks are copied to each other, a few times at most
PACK_BYTES = 2_000_000  # sets of one packed block
FOUND = 200_000  # linked texts that a task holds before it hands them on
PIVOTS = 16
PAIRS = 4_000_000  # comparisons of a region that are done block by block rather than divided further
LEVELS = 8  # rounds of pivots at most; then blocks compare what is left, however much it is

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
KEY_BITS = np.uint64(16)  # frequencies are counted by the first 48 bits of a hash: any order that is the same everywhere will do


def _combined(h: np.ndarray, size: int) -> np.ndarray:
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = mixed(out + h[i : i + n] * _FACTORS[i % len(_FACTORS)])
    return out


def shingle_sets(texts: list[bytes], size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word runs, all texts in a row, and the size of each set."""
    words = Words(texts)
    n = words.counts
    ends = np.cumsum(n)
    runs = _combined(words.hashes, size) if len(words.hashes) >= size else np.zeros(0, np.uint64)
    out, sizes = [], np.zeros(len(texts), np.int64)
    for k, (end, count) in enumerate(zip(ends.tolist(), n.tolist())):
        if count >= size:
            own = np.unique(runs[end - count : end - size + 1])
        elif count:
            own = _combined(words.hashes[end - count : end], count)
        else:
            continue
        out.append(own)
        sizes[k] = len(own)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), sizes


def required(size: np.ndarray | int, percent: int = PERCENT):
    return -(-size * percent // 100)


def prefix(own: np.ndarray, often: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Those of a set's first shingles, rarest first, that other texts hold too; ``often``: by how many each is held."""
    length = len(own) - required(len(own), percent) + 1
    shared = often > 1
    left = length - int((~shared).sum())
    if left <= 0:
        return own[:0]
    mine = own[shared]
    return mine[np.lexsort((mine, often[shared]))[:left]]


def intersections(sets: list[np.ndarray], step: int = 16_384) -> np.ndarray:
    """Sizes of all pairwise intersections, over the hashes that at least two sets hold."""
    m = len(sets)
    out = np.zeros((m, m), np.int64)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    if not len(owner):
        return out
    _, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    code = np.cumsum(count > 1) - 1
    keep = count[inverse] > 1
    owner, column = owner[keep], code[inverse[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    cuts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + step, step))
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        table = np.zeros((m, step), np.float32)
        table[owner[a:b], column[a:b] - k * step] = 1
        out += np.rint(table @ table.T).astype(np.int64)
    return out


def local_links(ids: np.ndarray, sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning star of every connected group of linked sets, by exact comparison."""
    size = np.array([len(s) for s in sets])
    both = intersections(sets)
    near = 100 * both >= percent * (size[:, None] + size[None] - both)
    np.fill_diagonal(near, False)
    root = ids.copy()
    while True:
        new = np.minimum(root, np.where(near, root[None], np.iinfo(np.int64).max).min(axis=1))
        if (new == root).all():
            return [(int(a), int(b)) for a, b in zip(ids, root) if a != b]
        root = new


def intersections_between(a: list[np.ndarray], b: list[np.ndarray], step: int = 16_384) -> np.ndarray:
    """Sizes of the intersections of all sets of ``a`` with all of ``b``."""
    out = np.zeros((len(a), len(b)), np.int64)
    flat = [np.concatenate(x) for x in (a, b)]
    both = np.intersect1d(*(np.unique(x) for x in flat), assume_unique=True)
    if not len(both):
        return out
    sides = []
    for x, sets in zip(flat, (a, b)):
        column = np.minimum(np.searchsorted(both, x), len(both) - 1)
        keep = both[column] == x
        owner, column = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[keep], column[keep]
        order = np.argsort(column, kind="stable")
        sides.append((owner[order], column[order], len(sets)))
    for start in range(0, len(both), step):
        tables = []
        for owner, column, m in sides:
            i, j = np.searchsorted(column, (start, start + step))
            table = np.zeros((m, step), np.float32)
            table[owner[i:j], column[i:j] - start] = 1
            tables.append(table)
        out += np.rint(tables[0] @ tables[1].T).astype(np.int64)
    return out


def links_between(a: tuple, b: tuple, percent: int = PERCENT) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect the linked sets of two blocks (ids, sets), by exact comparison."""
    (ids, sets), (other_ids, others) = a, b
    both = intersections_between(sets, others)
    sizes = np.array([len(s) for s in sets])[:, None] + np.array([len(s) for s in others])[None]
    near = 100 * both >= percent * (sizes - both)
    rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    if not len(rows):
        return []
    root, other = spread_roots(near[np.ix_(rows, columns)], ids[rows], other_ids[columns])
    return [(ids[rows], root), (other_ids[columns], other)]


def pack_sets(ids: np.ndarray, sets: list[bytes]) -> bytes:
    head = np.array([len(ids), *ids, *(len(s) // 8 for s in sets)], "<i8").tobytes()
    return zstandard.compress(head + b"".join(sets), 1)


def unpack_sets(payload: bytes) -> tuple[np.ndarray, list[np.ndarray]]:
    data = np.frombuffer(zstandard.decompress(payload), "<i8")
    m = int(data[0])
    return data[1 : 1 + m], np.split(data[1 + 2 * m :].view("<u8"), np.cumsum(data[1 + m : 2 * m]))


def _unpack(sets) -> list[np.ndarray]:
    return [np.frombuffer(s, "<u8") for s in sets]


# ------------------------------------------------------------------ chunks, buckets, prefixes

def _block_sets(payloads, size: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    shas, texts, _ = texts_of(payloads)
    parts = [shingle_sets(run, size) for _, run in slices_of(texts)]
    return shas, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _cuts(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return np.searchsorted(keys, (np.arange(1, n_buckets, dtype=np.float64) * (2.0**48 / n_buckets)).astype(np.uint64))


def candidates(docs: DataFrame, n_blocks: int, n_buckets: int, percent: int, size: int) -> DataFrame:
    """(sha, n, prefix, members): set size of every distinct text; prefix and set of those that may have partners."""
    dealt = blocks(docs.select("text", F.lit(1).alias("weight")), n_blocks)

    def send(part: pd.DataFrame) -> pd.DataFrame:
        _, flat, _ = _block_sets(part["payload"], size)
        keys, count = np.unique(flat >> KEY_BITS, return_counts=True)
        cuts = _cuts(keys, n_buckets)
        rows = [(b, int(part["block"].iloc[0]), squeeze_sorted(k), squeeze(c))
                for b, (k, c) in enumerate(zip(np.split(keys, cuts), np.split(count, cuts))) if len(k)]
        return pd.DataFrame(rows, columns=["bucket", "block", "keys", "counts"])

    sent = dealt.groupBy("block").applyInPandas(send, "bucket long, block long, keys binary, counts binary")

    def share(part: pd.DataFrame) -> pd.DataFrame:
        keys = [expand_sorted(k) for k in part["keys"]]
        flat = np.concatenate(keys)
        order = np.argsort(flat)
        starts = np.flatnonzero(np.concatenate([[True], flat[order][1:] != flat[order][:-1]]))
        counts = np.concatenate([expand(c) for c in part["counts"]])[order]
        each = np.empty(len(flat), np.uint64)
        each[order] = np.repeat(np.add.reduceat(counts, starts), np.diff(np.append(starts, len(flat))))
        often = np.split(each, np.cumsum([len(k) for k in keys])[:-1])
        return pd.DataFrame({"block": part["block"], "bucket": part["bucket"], "often": [squeeze(o) for o in often]})

    returned = sent.groupBy("bucket").applyInPandas(share, "block long, bucket long, often binary")

    def choose(part: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        shas, flat, sizes = _block_sets(part["payload"], size)
        # buckets are ranges of keys, and answer in the order they were asked
        often = np.concatenate([np.zeros(0, np.uint64), *(expand(o) for o in back.sort_values("bucket")["often"])])
        keys, inverse = np.unique(flat >> KEY_BITS, return_inverse=True)
        each = often[inverse]
        ends = np.cumsum(sizes)
        alone = np.concatenate([[0], np.cumsum(each == 1)])
        may = sizes - required(sizes, percent) + 1 > alone[ends] - alone[ends - sizes]
        rows = []
        for sha, n, end, likely in zip(shas, sizes.tolist(), ends.tolist(), may.tolist()):
            first, own = (), None
            if n and likely:
                first = prefix(flat[end - n : end], each[end - n : end], percent).astype(np.int64)
                own = flat[end - n : end].astype("<u8").tobytes()
            rows.append((sha, n, first, own))
        release()
        return pd.DataFrame(rows, columns=["sha", "n", "prefix", "members"])

    return dealt.groupBy("block").cogroup(returned.groupBy("block")).applyInPandas(choose, "sha string, n long, prefix array<long>, members binary")


# ------------------------------------------------------------------ regions

EDGE = "a long, b long"


def _leaf(part: pd.DataFrame, percent: int) -> pd.DataFrame:
    return pd.DataFrame(local_links(part["cid"].to_numpy(), _unpack(part["members"]), percent), columns=["a", "b"])


def _near_pivots(rows: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """(region, cid, linked, cells): each text's linked pivots, and the cells it goes to."""
    window = 2 * (1 - percent / 100) + 1e-9
    met = rows.join(pivots, "region").select("region", "cid", "members", "pivots")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple] = {}
        for part in parts:
            out = []
            for region, cid, members, pivots in zip(part["region"], part["cid"], part["members"], part["pivots"]):
                if region not in held:
                    held.clear()  # a partition's rows come sorted by region
                    sets = _unpack([p["members"] for p in pivots])
                    hashes = np.concatenate(sets)
                    order = np.argsort(hashes, kind="stable")
                    held[region] = (hashes[order], np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order],
                                    np.array([len(s) for s in sets]), [p["cid"] for p in pivots])
                hashes, owner, sizes, names = held[region]
                own = np.frombuffer(members, "<u8")
                lo, hi = np.searchsorted(hashes, own), np.searchsorted(hashes, own, side="right")
                at = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo) + np.arange((hi - lo).sum())
                both = np.bincount(owner[at], minlength=len(sizes))
                union = sizes + len(own) - both
                distance = 1 - both / union
                home = int(distance.argmin())
                cells = [home, *np.flatnonzero(distance[:home] <= distance[home] + window).tolist()]
                linked = [names[j] for j in np.flatnonzero(100 * both >= percent * union) if names[j] != cid]
                out.append((region, cid, linked, cells))
            yield pd.DataFrame(out, columns=["region", "cid", "linked", "cells"])

    return met.mapInPandas(run, "region long, cid long, linked array<long>, cells array<int>")


def region_links(rows: DataFrame, percent: int = PERCENT, leaf: int = LEAF, n_pivots: int = PIVOTS, levels: int = LEVELS,
                 pairs: int = PAIRS, block: int = BLOCK, rounds: list[int] | None = None, wide: int = WIDE) -> DataFrame:
    """Edges that connect exactly the linked texts of each region; ``rows``: (region, size, cid, members).

    A round compares small regions at once and gives large ones pivots.  Then a region
    whose texts are all connected is done.  What is left to compare in a region is its
    texts outside the largest component, with all others: if that is little, or the
    Voronoi cells together wouldn't leave less, blocks are compared; else the cells are
    the next round's regions.  ``rounds`` takes the number of regions that each round
    of pivots divides.
    """
    sized = rows.withColumns({"before": F.lit(0).cast("long"), "major": F.lit(-1).cast("long"), "n_major": F.lit(0).cast("long"), "comp": F.col("cid")})
    edges = no_rows(rows.sparkSession, EDGE)
    level = 0
    while sized.head(1):
        rest = (F.col("size") - F.col("n_major")) * F.col("size")
        stuck = (F.lit(level >= levels) | (rest <= pairs) | ((F.col("before") > 0) & (F.col("size") > 0.7 * F.col("before")))) & F.lit(level > 0)
        sized = sized.withColumn("way", F.when(F.col("size") <= leaf, 0).when(stuck, 1).otherwise(2))
        small = sized.where("way = 0").groupBy("region").applyInPandas(lambda p: _leaf(p, percent), EDGE)
        edges = edges.union(staged(small.union(_by_blocks(sized.where("way = 1"), percent, block, wide)), "edges"))
        large = sized.where("way = 2")
        if not large.head(1):
            break
        rank = F.row_number().over(Window.partitionBy("region").orderBy(F.xxhash64(F.lit(level), "cid"), "cid"))
        chosen = large.withColumn("rank", rank).where(F.col("rank") <= n_pivots)
        pivots = staged(chosen.groupBy("region").agg(F.collect_list(F.struct("cid", "members")).alias("pivots")), "pivots")
        if rounds is not None:
            rounds.append(pivots.count())
        near = staged(_near_pivots(large.select("region", "cid", "members"), pivots, percent), "cells")
        edges = edges.union(staged(near.select(F.col("cid").alias("a"), F.explode("linked").alias("b")), "edges"))
        comps = staged(components(edges), "components").select(F.col("node").alias("cid"), F.col("component").alias("comp"))
        known = staged(near.select("region", "cid", "cells").join(small_side(comps), "cid", "left").withColumn("comp", F.coalesce("comp", "cid")), "connected")
        # the region itself is done, or little is left of it, or as much in its cells: each of them may hold most of the region
        left = (F.col("size") - F.col("n_major")) * F.col("size")
        later = _sizes(known.select("region", F.explode("cells").alias("cell"), "comp"), "region", "cell").groupBy("region").agg(F.sum(left).alias("later"))
        whole = _sizes(known.select("region", "comp")).join(later, "region").where((left <= pairs) | (F.col("later") > 0.7 * left)).drop("later")
        done = small_side(staged(whole, "little-left"))
        texts = large.select("region", "cid", "members", F.col("size").alias("before"))
        little = texts.join(small_side(staged(known.select("region", "cid", "comp").join(done, "region"), "little")), ["region", "cid"])
        edges = edges.union(staged(_by_blocks(little, percent, block, wide), "edges"))
        further = staged(known.join(done.select("region"), "region", "left_anti"), "further")
        cells = texts.join(small_side(further), ["region", "cid"]).select(F.explode("cells").alias("cell"), "region", "before", "cid", "members", "comp")
        rows = staged(cells.select(F.xxhash64("region", "cell", F.lit(level)).alias("region"), "before", "cid", "members", "comp"), "regions")
        sizes = staged(_sizes(rows.select("region", "comp")).where("size > n_major"), "sizes")
        # written, so that a large region's rows may be split in this join
        sized = staged(rows.join(small_side(sizes), "region"), "sized")
        level += 1
    return edges


def _sizes(rows: DataFrame, *keys: str) -> DataFrame:
    """(region, size, major, n_major): a region's texts, its largest component and that one's size; ``keys`` instead of the region."""
    keys = keys or ("region",)
    counted = rows.groupBy(*keys, "comp").agg(F.count("*").alias("n"))
    return counted.groupBy(*keys).agg(F.sum("n").alias("size"), F.max(F.struct("n", "comp")).alias("m")).select(
        *keys, "size", F.col("m.comp").alias("major"), F.col("m.n").alias("n_major"))


def _by_blocks(large: DataFrame, percent: int, block: int, wide: int = WIDE) -> DataFrame:
    """Compare what pivots need not or could not divide, block by block.

    Texts outside a region's largest component meet all blocks; blocks of the
    largest component need not meet each other.  In small regions every block is
    copied to those that it meets; blocks of wide ones are packed, and meet over
    the files they are written to.
    """
    half = max(1, block // 2)
    inner = F.col("comp") == F.col("major")
    n_inner, n_outer = F.ceil(F.col("n_major") / half), F.ceil((F.col("size") - F.col("n_major")) / half)
    own = F.when(inner, F.pmod(F.xxhash64("cid"), n_inner)).otherwise(n_inner + F.pmod(F.xxhash64("cid"), F.greatest(n_outer, F.lit(1))))
    lowest = F.when(inner, n_inner).otherwise(F.lit(0)).cast("long")
    others = F.when(n_outer > 0, F.sequence(lowest, (n_inner + n_outer - 1).cast("long")))
    dealt = large.withColumn("block", own.cast("long"))
    paired = dealt.where(F.col("size") <= wide).withColumn("other", F.explode(others)).withColumns({"b1": F.least("block", "other"), "b2": F.greatest("block", "other")})
    copied = paired.select("region", "b1", "b2", "cid", "members").groupBy("region", "b1", "b2").applyInPandas(lambda p: _leaf(p, percent), EDGE)

    def pack(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("cid")
        ids, sets = part["cid"].to_numpy(), part["members"].tolist()
        cuts = np.flatnonzero(np.diff(np.cumsum([len(s) for s in sets]) // PACK_BYTES)) + 1
        runs = zip([0, *cuts], [*cuts, len(ids)])
        return pd.DataFrame([(key[0], key[1] * 1_000_000 + k, key[2], pack_sets(ids[i:j], sets[i:j])) for k, (i, j) in enumerate(runs)],
                            columns=["region", "block", "inner", "payload"])

    packed = staged(dealt.where((F.col("size") > wide) & (n_outer > 0)).withColumn("inner", inner).select("region", "block", "inner", "cid", "members")
                    .groupBy("region", "block", "inner").applyInPandas(pack, "region long, block long, inner boolean, payload binary"), "blocks")
    if not packed.head(1):
        return copied

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, found, many = BlockCache(), [], 0

        def added() -> tuple[np.ndarray, np.ndarray]:
            return least_roots(*(np.concatenate(c) for c in zip(*found)))

        def out(names: np.ndarray, roots: np.ndarray) -> pa.RecordBatch:
            linked = names != roots
            return pa.RecordBatch.from_arrays([pa.array(names[linked]), pa.array(roots[linked])], names=["a", "b"])

        for batch in batches:
            for row in range(batch.num_rows):
                a, b = cache.two(batch, row, unpack_sets, ("region",))
                if a is b:
                    links = local_links(*a, percent)
                    new = [tuple(np.array(c, np.int64) for c in zip(*links))] if links else []
                else:
                    new = links_between(a, b, percent)
                found += new
                many += sum(len(c[0]) for c in new)
            if many > FOUND:
                names, roots = added()
                found, many = [(names, roots)], 0
                if len(names) > FOUND:
                    yield out(names, roots)
                    found = []
        if found:
            yield out(*added())

    met = block_pairs(packed, ["region"], ~(F.col("a_inner") & F.col("b_inner"))).drop("a_inner", "b_inner")
    with batch_rows(large.sparkSession, 4):
        return copied.union(staged(met.mapInArrow(compare, EDGE), "edges"))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, size: int = WORDS, id_col: str = "doc_id", text_col: str = "text",
                    leaf: int = LEAF, n_pivots: int = PIVOTS, levels: int = LEVELS, pairs: int = PAIRS, block: int = BLOCK,
                    block_bytes: int = BLOCK_BYTES, rounds: list[int] | None = None, wide: int = WIDE) -> DataFrame:
    """(id, sha, n_shingles, component_id, group), one row per document; linked documents have the same group."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks, n_buckets = partitions_for(total, block_bytes), partitions_for(total, BUCKET_BYTES)
    found = staged(candidates(rows, n_blocks, n_buckets, percent, size), "candidates")
    drop_shuffles(docs.sparkSession)  # twice the input

    # texts with the same set are one class
    likely = found.where(F.size("prefix") > 0)
    classes = likely.groupBy(F.sha2("members", 256).alias("sig")).agg(F.first("members").alias("members"), F.first("prefix").alias("prefix"))
    classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "sets")
    holders = classes.select("cid", F.explode("prefix").alias("hash"))
    least = staged(holders.groupBy("hash").agg(F.min("cid").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n"), "least")
    meets = holders.join(least, "hash").select(F.col("cid").alias("a"), F.col("first").alias("b"))
    first = staged(components(meets.distinct()), "meets").select(F.col("node").alias("cid"), F.col("component").alias("region"))
    first = first.join(small_side(staged(first.groupBy("region").agg(F.count("*").alias("size")), "region-sizes")), "region")
    regions = staged(classes.select("cid", "members").join(small_side(staged(first, "sized")), "cid").select("region", "size", "cid", "members"), "first-regions")
    linked = staged(components(region_links(regions, percent, leaf, n_pivots, levels, pairs, block, rounds, wide)), "linked")

    group = classes.select("sig", "cid").join(small_side(linked.withColumnRenamed("node", "cid")), "cid", "left").select(
        "sig", F.coalesce("component", "cid").alias("group"))
    texts = found.select("sha", "n", F.when(F.size("prefix") > 0, F.sha2("members", 256)).alias("sig"))
    texts = staged(texts.join(small_side(staged(group, "groups")), "sig", "left").select("sha", "n", F.coalesce(F.col("group").cast("string"), "sha").alias("group")), "texts")
    ids = rows.select("id", F.sha2("text", 256).alias("sha"))
    by_text = staged(ids.groupBy("sha").agg(F.min("id").alias("least")), "text-ids").join(texts, "sha")
    by_group = staged(by_text.groupBy("group").agg(F.min("least").alias("component_id")), "group-ids")
    known = staged(texts.join(small_side(by_group), "group").select("sha", "n", "component_id", "group"), "known")
    out = ids.join(small_side(known), "sha")
    return out.select(F.col("id").alias(id_col), "sha", F.col("n").alias("n_shingles"),
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), "group")

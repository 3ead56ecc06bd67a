"""Operators 5 and 10 against brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF
from tidemark.llm import embedding_dedup, jaccard_join
from tidemark.llm.components import components
from tidemark.llm.queries import ORACLE, QUERIES


def group(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = random.Random(seed)
    chain = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)]
    pairs = chain + [(r.randrange(100), r.randrange(100)) for _ in range(60)]
    want = group(600, pairs)
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert got == {n: want[n] for p in pairs for n in p if p[0] != p[1] or n in got}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors_by_hand(rows, t=0.98):
    ok = [r[1] is not None and r[2] is not None and len(r[2]) > 0 and all(v is not None and np.isfinite(v) for v in r[2]) and any(r[2]) for r in rows]
    pairs = []
    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if ok[i] and ok[j] and a[1] == b[1] and len(a[2]) == len(b[2]):
                x, y = np.array(a[2], float), np.array(b[2], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= t:
                    pairs.append((i, j))
    root = group(len(rows), pairs)
    n = [sum(i in p for p in pairs) for i in range(len(rows))]
    big = float("inf")
    least = {}
    for i, r in enumerate(root):
        least[r] = min(least.get(r, big), big if rows[i][0] is None else rows[i][0])
    comp = [None if least[r] == big else least[r] for r in root]
    return sorted(((str(r[0]), n[i], str(comp[i]), r[0] == comp[i]) for i, r in enumerate(rows)))


def shown(df):
    return sorted((str(r[0]), r[1], str(r[2]), r[3]) for r in df.collect())


def test_op5_whole_table(spark):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    assert shown(QUERIES["op5_embedding_dedup"](spark, SF)) == vectors_by_hand(rows)


@pytest.mark.parametrize(("cells", "block"), [(15, 8), (1, 1000), (5, 40)])
def test_op5_cells_blocks_and_odd_rows(spark, monkeypatch, cells, block):
    monkeypatch.setattr(embedding_dedup, "CELLS", (cells,))
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    r = np.random.default_rng(3)
    rows = []
    for c in r.normal(size=(12, 8)):
        rows += [(len(rows) + k, int(len(rows) % 2), (c + r.normal(size=8) * s).tolist()) for k, s in enumerate(r.choice([0.02, 0.1, 0.3], 25))]
    rows += [(1, 0, rows[0][2])] * 5 + [(None, 0, rows[3][2]), (900, None, rows[0][2]), (901, 0, None), (902, 0, []), (903, 0, [0.0] * 8),
                                        (904, 0, [float("nan")] * 8), (905, 0, [None] * 8), (906, 1, [1.0, 2.0]), (907, 1, [2.0, 4.0]), (None, 1, None)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({"cid": F.lit(1), "n": F.lit(2), "x": F.lit("x")})
    assert shown(embedding_dedup.near_duplicates(df)) == vectors_by_hand(rows)
    assert embedding_dedup.near_duplicates(df.where("false")).count() == 0


def test_op5_uses_several_cells_and_more_of_them_for_more_clusters(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").where("embedding is not null").collect()
    x, labels = np.array([r["embedding"] for r in rows], float), np.array([r["label"] or 0 for r in rows])
    assert len(embedding_dedup.chosen_centroids(x, labels, 0.98, 1)) > 1
    r = np.random.default_rng(1)
    for clusters in (4, 64):
        x = np.repeat(r.normal(size=(clusters, 32)), 2560 // clusters, axis=0) + r.normal(size=(2560, 32)) * 0.01
        assert len(embedding_dedup.chosen_centroids(x, np.zeros(len(x)), 0.98, 1000)) >= clusters


def test_op5_disk_does_not_grow_with_the_blocks_of_a_cell(spark, monkeypatch):
    """Vectors are written once for a cell however many blocks it has, and nothing is shuffled to compare them."""
    r = np.random.default_rng(4)
    rows = [(i, 0, v) for i, v in enumerate((np.repeat(r.normal(size=(60, 16)), 10, axis=0) + r.normal(size=(600, 16)) * 0.05).tolist())]
    df, written, plans = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), [], {}

    def staged(df, name, write=embedding_dedup.staged):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        out = write(df, name)
        if name == "cells":
            written.append(out.agg(F.sum(F.length("payload") / (17 + 16 * 8))).first()[0])
        return out

    monkeypatch.setattr(embedding_dedup, "staged", staged)
    for block in (4, 1000):
        monkeypatch.setattr(embedding_dedup, "BLOCK", block)
        assert shown(embedding_dedup.near_duplicates(df)) == vectors_by_hand(rows)
        assert "Exchange" not in plans["links"]
    assert written[0] == written[1] <= embedding_dedup.COPIES * len(rows)


def test_op5_pairs_at_the_threshold_are_told_in_double():
    """Cosines a few units in the last place of single precision above and below: as when all is double."""
    r = np.random.default_rng(6)
    x = r.normal(size=(40, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = r.normal(size=x.shape)
    side -= (side * x).sum(axis=1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    cos = 0.98 + r.integers(-8, 9, 40) * 1e-8
    y = x * cos[:, None] + side * np.sqrt(1 - cos**2)[:, None]
    near = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((y * y).sum(axis=1)) >= 0.98
    assert 0 < near.sum() < 40
    one, ids = np.ones(40), np.arange(40)
    a, b = (embedding_dedup.Block(embedding_dedup.pack_block(i, one, one, v), 24, "<f8") for i, v in ((ids, x), (ids + 100, y)))
    (names, links, root), = embedding_dedup._added([embedding_dedup.block_links(a, b, 0.98)])
    assert sorted(names) == sorted([*ids[near], *ids[near] + 100]) and set(links) == {1} and (root == names % 100).all()


def set_of(text, size=5):
    ws = (text or "").encode().lower().split()
    return {tuple(ws)} if 0 < len(ws) < size else {tuple(ws[i : i + size]) for i in range(len(ws) - size + 1)}


def documents_by_hand(rows):
    sets = [set_of(t) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = set()
    for hs in holders.values():
        pairs.update((a, b) for k, a in enumerate(hs) for b in hs[:k])
    linked = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root, big, least = group(len(rows), linked), float("inf"), {}
    for i, g in enumerate(root):
        least[g] = min(least.get(g, big), big if rows[i][0] is None else rows[i][0])
    return sorted((str(r[0]), len(sets[i]), str(None if least[root[i]] == big else least[root[i]])) for i, r in enumerate(rows))


def triples(df):
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in df.collect())


def test_op10_whole_table(spark):
    rows = list(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    assert triples(QUERIES["op10_jaccard_join"](spark, SF)) == documents_by_hand(rows)


def test_op10_divides_a_region_of_some_dozen_texts_by_pivots(spark):
    """Edits of one text, no two equal: one region, which pivots divide at the settings in use."""
    r = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        own = list(base)
        for k in r.sample(range(120), r.randint(1, 6)):
            own[k] = f"x{i}.{k}"
        rows.append((i, " ".join(own)))
    rounds = []
    got = jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), rounds=rounds)
    assert triples(got) == documents_by_hand(rows) and rounds and rounds[0] == 1


def test_op10_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert triples(jaccard_join.near_duplicates(odd_docs)) == documents_by_hand(rows)
    assert jaccard_join.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize(("leaf", "pivots", "levels", "pairs"), [(4, 2, 3, 0), (6, 3, 1, 0), (3, 2, 8, 60)])
def test_op10_recursion_and_blocks(spark, leaf, pivots, levels, pairs):
    """Chains of edits around the threshold in one large region, with a common passage."""
    r = random.Random(leaf)
    words = [f"w{i}" for i in range(400)]
    rows, passage = [], [r.choice(words) for _ in range(30)]
    for _ in range(4):
        base = [r.choice(words) for _ in range(60)]
        for _ in range(14):
            base = base[:]
            for _ in range(r.randrange(4)):
                base[r.randrange(len(base))] = r.choice(words)
            rows.append((len(rows), " ".join(base)))
    rows += [(len(rows) + k, " ".join(passage + [r.choice(words) for _ in range(6 + k % 3)])) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = triples(jaccard_join.near_duplicates(docs, leaf=leaf, n_pivots=pivots, levels=levels, pairs=pairs, block=leaf, block_bytes=3000))
    assert got == documents_by_hand(rows)


def edits(r, n, words, most):
    """Copies of one text with up to ``most`` words changed, no two changes the same."""
    rows = []
    for i in range(n):
        own = [f"w{k}" for k in range(words)]
        for k in r.sample(range(words), r.randint(1, most)):
            own[k] = f"x{i}.{k}"
        rows.append((i, " ".join(own)))
    return rows


def test_op10_disk_does_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    """A wide region of which pivots connect a part only: its sets are written a few times, however many blocks they make."""
    rows, plans, written = edits(random.Random(5), 160, 60, 6), [], []

    def staged(df, name, write=jaccard_join.staged):
        out = write(df, name)
        if name in ("regions", "blocks", "edges"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        if "members" in out.columns and name in ("regions", "sized", "cells", "connected"):
            written.append(out.count())
        if name == "blocks":
            written.append(sum(len(jaccard_join.unpack_sets(bytes(p["payload"]))[0]) for p in out.collect()))
        return out

    monkeypatch.setattr(jaccard_join, "staged", staged)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.near_duplicates(docs, leaf=4, n_pivots=2, pairs=0, block=4, wide=8)
    assert triples(got) == documents_by_hand(rows)
    assert any("CartesianProduct" in p for p in plans) and sum(written) <= 4 * len(rows)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=25), min_size=2, max_size=8), st.integers(1, 7))
def test_op10_links_between_blocks(sets, cut):
    """Two blocks that meet, and each with itself, connect what one block of all does."""
    ids, arrays = np.arange(len(sets)), [np.array(sorted(s), np.uint64) for s in sets]
    parts = [jaccard_join.unpack_sets(jaccard_join.pack_sets(ids[i], [a.astype("<u8").tobytes() for a in arrays[i]])) for i in (slice(0, cut), slice(cut, None))]
    pairs = [(int(a), int(b)) for p in parts if len(p[0]) for a, b in jaccard_join.local_links(*p)]
    if all(len(p[0]) for p in parts):
        assert jaccard_join.intersections_between(parts[0][1], parts[1][1], step=4).tolist() == [[len(a & b) for b in sets[cut:]] for a in sets[:cut]]
        pairs += [(int(a), int(b)) for c in jaccard_join.links_between(*parts) for a, b in zip(*c)]
    links = dict(jaccard_join.local_links(ids, arrays))
    assert group(len(sets), pairs) == [links.get(i, i) for i in range(len(sets))]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 30), min_size=1, max_size=25), min_size=2, max_size=8))
def test_op10_prefixes_and_local_links(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    inter = jaccard_join.intersections(arrays, step=4)
    assert inter[~np.eye(len(sets), dtype=bool)].tolist() == [len(a & b) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j]
    values, count = np.unique(np.concatenate(arrays), return_counts=True)
    firsts = [set(jaccard_join.prefix(a, count[np.searchsorted(values, a)]).tolist()) for a in arrays]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    assert all(firsts[i] & firsts[j] for i, j in pairs)
    links = dict(jaccard_join.local_links(np.arange(len(sets)), arrays))
    assert [links.get(i, i) for i in range(len(sets))] == group(len(sets), pairs)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = con.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    got = QUERIES[name](spark, SF)
    assert set(columns) == set(got.columns)
    assert sorted(found.fetchall()) == sorted(map(tuple, got.select(*columns).collect()))

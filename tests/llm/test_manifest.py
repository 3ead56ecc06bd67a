"""Operator 13 against a tree built by recursion."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.common import fold

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_by_hand(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_by_hand(row):
    out = [row]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings_by_hand(levels, i):
    out = []
    for row in levels[:-1]:
        first = i - i % 8
        out.append((i - first, row[first:i] + row[i + 1 : first + 8]))
        i //= 8
    return out


def by_hand(rows):
    """{doc_id: expected row} of rows (doc_id, source, lang, n_chars, text) with distinct ids."""
    trees = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    built = [levels_by_hand([leaf_by_hand(r) for r in trees[t]]) for t in order]
    top = levels_by_hand([b[-1][0] for b in built])
    out = {}
    for k, (t, levels) in enumerate(zip(order, built)):
        for i, r in enumerate(trees[t]):
            path = siblings_by_hand(levels, i) + siblings_by_hand(top, k)
            tampered = zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 3 == 0 and r[4] is not None
            at = leaf_by_hand(r[:4] + (r[4].translate(LOWER),)) if tampered else levels[0][i]
            for own, run in path:
                at = sha("".join([*run[:own], at, *run[own:]]))
            out[r[0]] = (r[0], levels[0][i], levels[-1][0], top[-1][0], sha("".join(d for _, run in path for d in run)), at, at == top[-1][0])
    return out


def proven(docs, **options):
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    trees, top = merkle.manifest(docs, changed=("text", lowered, fold("doc_id", 3) == 0), **options)
    return trees, top, merkle.proofs(trees, top)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, None: 1}, {None: 9, "en": 65, "é": 2, "": 1}, {"a": 130, **{f"l{k}": 1 for k in range(9)}}])
def test_proofs_by_hand_in_several_rounds(spark, sizes):
    rows, n = [], 0
    for lang, k in sizes.items():
        for _ in range(k):
            rows.append((n * 7 - 20, None if n % 5 else "src", lang, n if n % 3 else None, [None, "", f"Text {n} É", "plain"][n % 4]))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    trees, top, got = proven(docs, levels=1)  # eight children a builder: many rounds
    want = by_hand(rows)
    assert {r[0]: tuple(r) for r in got.collect()} == want
    # the log holds every tree whole, in postorder
    log = {}
    for tree, position, digests in trees.log().collect():
        assert len(digests) % 32 == 0
        for i in range(len(digests) // 32):
            assert log.setdefault(tree, {}).setdefault(position + i, bytes(digests[32 * i : 32 * i + 32]).hex()) is not None
    for lang in sizes:
        leaves = [leaf_by_hand(r) for r in sorted(r for r in rows if r[2] == lang)] if lang is not None else [
            leaf_by_hand(r) for r in sorted((r for r in rows if r[2] is None), key=lambda r: r[0])]
        levels = levels_by_hand(leaves)
        own = log["-" if lang is None else f"={lang}"]
        assert sorted(own) == list(range(sum(map(len, levels))))
        for level, row in enumerate(levels):
            for j, digest in enumerate(row):
                assert own[merkle.position(level, j, len(leaves))] == digest
    assert {r["root"] for r in top.roots().collect()} == {v[3] for v in want.values()}


def test_closed_form_is_the_order_of_completion():
    for n in [*range(1, 140), 511, 512, 513, 600]:
        row = [f"{i:064x}" for i in range(n)]
        levels = levels_by_hand(row)
        log = merkle.appended(row, merkle.height(n))
        assert len(log) == sum(map(len, levels))
        for level, nodes in enumerate(levels):
            assert [log[merkle.position(level, j, n)] for j in range(len(nodes))] == nodes
        for i in (0, n // 2, n - 1):
            flat = [d for _, run in siblings_by_hand(levels, i) for d in run]
            assert [log[p] for p in merkle.sibling_positions(i, n, merkle.height(n))] == flat
            assert merkle.folded(row[i], flat, i, n) == levels[-1][0]
            assert len(flat) == merkle.siblings(i, n)


def test_tampering_is_found_only_where_text_changes(spark):
    rows = [(i, "s", "en", 5, "Upper" if i % 2 else "lower") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    bad = {r["doc_id"] if "doc_id" in r else r["id"] for r in proven(docs)[2].where("not verified").collect()}
    assert bad == {i for i in range(40) if i % 2 and zlib.crc32(str(i).encode()) % 3 == 0}


def test_odd_rows(spark, odd_docs, no_docs):
    odd = odd_docs.withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.length("text"))
    got = proven(odd)[2].collect()
    assert len(got) == odd.count() and len({r["root"] for r in got}) == 1
    assert sum(r["leaf"] == got[0]["leaf"] for r in got) >= 1
    repeated = [r for r in got if r["id"] == 1]
    assert len(repeated) == 2 and repeated[0]["leaf"] == repeated[1]["leaf"]
    assert proven(no_docs.withColumn("source", F.lit("")).withColumn("n_chars", F.lit(1)))[2].count() == 0
    # other columns don't matter
    assert {r["root"] for r in proven(odd.select("doc_id", "source", "lang", "n_chars", "text"))[2].collect()} == {got[0]["root"]}

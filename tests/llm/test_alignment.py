"""Operator 12 against both libraries and a count over all documents by hand."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF
from tidemark.llm import alignment, bpe, pieces
from tidemark.llm.queries import QUERIES
from tidemark.llm.text_blocks import squeeze, squeeze_sorted

A, B = P.path("byte_bpe_50k.json"), P.path(pieces.MODEL)
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def tools(cache=[]):  # noqa: B006
    if not cache:
        first = Tokenizer.from_file(A)
        first.encode_special_tokens = True
        back = {c: b for b, c in enumerate(bpe.byte_table())}
        own = alignment.Aligner(A, B, 300)
        cache.extend([first, {i: bytes(back[c] for c in t) for t, i in first.get_vocab().items() if i != 50256}, own.b.pieces.library, own])
    return cache


def tokens(text):
    """[(id, first byte, end)] of both sides; none where a side's bytes differ from the space and the text."""
    first, a_bytes, second, _ = tools()
    if not text:
        return [], []
    raw, sides = (" " + text).encode(), []
    b_bytes = lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
    for ids, to_bytes in ((first.encode(" " + text, add_special_tokens=False).ids, a_bytes.__getitem__), (second.encode(text), b_bytes)):
        at, side = 0, []
        for i in ids:
            side.append((i, at, at := at + len(to_bytes(i))))
        if b"".join(map(to_bytes, ids)) != raw:
            return [], []
        sides.append(side)
    return tuple(sides)


def grouped(a, b):
    ends = sorted({e for *_, e in a} & {e for *_, e in b})
    out, sides = [], [list(reversed(a)), list(reversed(b))]
    for end in ends:
        own = [[], []]
        for side, ids in zip(sides, own):
            while side and side[-1][2] <= end:
                ids.append(str(side.pop()[0]))
        out.append("|".join(map(",".join, own)))
    return out


def by_hand(docs):
    described, held = [], defaultdict(int)
    for d, text in docs:
        a, b = tokens(text)
        links, k = Counter(), 0
        for i, s, e in a:
            while k < len(b) and b[k][2] <= s:
                k += 1
            for j, x, _ in itertools_while(b, k, e):
                links[i, j] += 1
        for pair in links:
            held[pair] += 1
        described.append((d, a, b, links))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    out = []
    for d, a, b, links in described:
        g = grouped(a, b)
        out.append((d, len(a), len(b), len(g), sum(links.values()), sum(n for p, n in links.items() if held[p] == most[p[0]]),
                    sum(n * held[p] for p, n in links.items()), hashlib.sha256(";".join(g).encode()).hexdigest() if a else ""))
    return out


def itertools_while(b, k, end):
    while k < len(b) and b[k][1] < end:
        yield b[k]
        k += 1


def key(row):
    return tuple(map(str, row))


AWKWARD = ["", " ", "a", " a", "a  b ", "▁x", "x▁", "a\0b", "naïve 漢字 🙂🙂", "it's <|endoftext|> <s>ok</s>", "x);\r", "x) \r\n y", "a\n\n\nb  c\t\td", "x\xa0 \xa0 y",
           "foo,bar.", "\x1c a \x1c b", "don't_stop (now)!", "1,000.5", "’s “quoted”."]


def aligned_by_units(texts):
    own = tools()[3]
    own.begin_chunk()
    units, n = own.numbers(texts)
    ends = np.cumsum(n)
    return ["".join(own.text[u] for u in units[e - k : e].tolist())[:-1] for e, k in zip(ends, n)]


def test_awkward_texts_by_units():
    for texts in (AWKWARD, AWKWARD[::-1], AWKWARD):
        assert aligned_by_units(texts) == [";".join(grouped(*tokens(t))) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab'\n\t \r,.;é漢\xa0\x85\x1cs)1_", max_size=30), min_size=1, max_size=4))
def test_random_texts_by_units(texts):
    assert aligned_by_units(texts) == [";".join(grouped(*tokens(t))) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), min_size=1, max_size=40), max_size=6), st.integers(1, 7))
def test_heap_merge_counts_every_key_once(runs, page):
    packed, want = [], Counter()
    for run in runs:
        keys = sorted(set(run))
        want.update(keys)
        packed.append([(squeeze_sorted(np.array(keys[i : i + page], np.uint64)), squeeze(np.ones(len(keys[i : i + page]), np.int64)))
                       for i in range(0, len(keys), page)])
    got = [(k, c) for keys, counts in alignment.heap_merge(packed) for k, c in zip(keys.tolist(), counts.tolist())]
    assert got == sorted(want.items())


def test_maxima_of_ids_that_cross_blocks():
    keys = np.array([1 << 32 | 1, 1 << 32 | 5, 1 << 32 | 9, 2 << 32, 3 << 32, 3 << 32 | 1], np.uint64)
    counts = np.array([2, 7, 7, 1, 4, 3])
    for cut in range(1, 6):
        blocks = [(keys[:cut], counts[:cut]), (keys[cut:], counts[cut:])]
        got = [np.concatenate(x).tolist() for x in zip(*alignment.with_maxima(iter(blocks)))]
        assert got == [keys.tolist(), counts.tolist(), [False, True, True, True, True, False]]


@pytest.mark.parametrize("chunk_bytes,fan_in", [(30_000, 2), (alignment.CHUNK_BYTES, alignment.FAN_IN)])
def test_small_chunks_and_many_merges(spark, chunk_bytes, fan_in):
    """Some thousand bytes a chunk and two runs a merge: several rounds, several copies of the counts."""
    rows = [(d, t) for d, t in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()][:40]
    docs = spark.createDataFrame(rows + [(1000 + i, t) for i, t in enumerate(AWKWARD)] + rows[:3], "doc_id long, text string").repartition(5)
    got = alignment.aligned(docs, A, B, chunk_bytes=chunk_bytes, fan_in=fan_in).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=key) == sorted(by_hand(docs.collect()), key=key)


def test_op12_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, QUERIES["op12_token_alignment"](spark, SF).select(COLUMNS).collect())) == sorted(by_hand(rows))


def test_odd_rows(spark, odd_docs, no_docs):
    got = alignment.aligned(odd_docs, A, B).select(COLUMNS).collect()
    assert sorted(map(tuple, got), key=key) == sorted(by_hand(odd_docs.select("doc_id", "text").collect()), key=key)
    assert alignment.aligned(no_docs, A, B).count() == 0
    empty = alignment.aligned(odd_docs.where("doc_id in (2, 3)"), A, B).select(COLUMNS).collect()
    assert sorted(map(tuple, empty)) == [(2, 0, 0, 0, 0, 0, 0, ""), (3, 0, 0, 0, 0, 0, 0, "")]

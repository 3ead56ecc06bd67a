"""Operator 11 against the sentencepiece library."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import public_tokenizers as P
from conftest import SF
from tidemark.llm import pieces
from tidemark.llm.queries import QUERIES

MODEL = P.path(pieces.MODEL)
AWKWARD = ["", " ", "  ", "a ", " a", "a \n b", "x\n\n b", "　 x", "a  b  ", "\n ", "a   b", "\0a b", "▁x▁▁y", "  \n  \t x\r\n", "naïve 漢字 🙂🙂",
           "<s>x</s><unk><0x0A>", " " * 100, "a" * 70 + " " * 33 + "b", "ﬁ①", "\r\r\r\n();\r", "x" * 5000, "é" * 999, "’s “quoted”. «so», (†", "1,000.5²."]


@pytest.fixture(scope="module")
def enc():
    return pieces.PieceEncoder(pieces.Pieces(MODEL), 1000)


def check(enc, texts):
    flat, counts = enc.encode(texts)
    got = [p.tolist() for p in np.split(flat, np.cumsum(counts)[:-1])]
    assert got == enc.pieces.library.encode(texts)


def test_awkward_texts(enc):
    for texts in (AWKWARD, AWKWARD[::-1], AWKWARD):
        check(enc, texts)
    assert all(len(u) <= pieces.LONGEST for u in enc.at)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ernstaodi ▁\n\r.,'é(;)1", max_size=60), min_size=1, max_size=5))
def test_random_texts(texts):
    check(_shared(), texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(3, 31_999), max_size=12))
def test_random_pieces(ids):
    own = _shared()
    check(own, ["".join(own.pieces.text.get(i, "") for i in ids)])


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_any_characters(text):
    check(_shared(), [text])


def _shared(cache=[]):  # noqa: B006
    if not cache:
        cache.append(pieces.PieceEncoder(pieces.Pieces(MODEL), 500))
    return cache[0]


def test_backtracking_steps_back(enc):
    """Words where the longest first piece leaves a rest that fits nowhere."""
    p, stepped = enc.pieces, 0
    for word in list(p.text.values())[5000:9000]:
        word = word + "ing"
        ids = p.encoded([word])[0]
        assert [p.text[i] for i in ids] == p.merged(word)
        stepped += p.size[ids[0]] < max(k for k in range(1, len(word) + 1) if p.id.get(word[:k]) in p.text)
    assert stepped > 100


def want(lib, d, t):
    ids = lib.encode(t or "", add_bos=True, add_eos=True)
    return d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_op11_whole_table_and_odd_rows(spark, enc, odd_docs, no_docs):
    lib = enc.pieces.library
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, QUERIES["op11_piece_bpe"](spark, SF).collect())) == sorted(want(lib, *r) for r in rows)
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    trip = pieces.digests(pieces.round_trip(odd_docs, MODEL)).collect()
    two_steps = pieces.digests(pieces.decode(pieces.encode(odd_docs, MODEL), MODEL)).collect()
    expected = sorted((want(lib, r["doc_id"], r["text"]) for r in odd_docs.collect()), key=key)
    assert sorted(map(tuple, trip), key=key) == sorted(map(tuple, two_steps), key=key) == expected
    assert pieces.round_trip(no_docs, MODEL).count() == pieces.encode(no_docs, MODEL).count() == 0
    assert {r["doc_id"]: r["ids"] for r in pieces.encode(odd_docs.where("doc_id = 3"), MODEL, ends=False).collect()} == {3: []}


def test_decoding_ids_that_no_encoding_gives(spark, enc):
    lib = enc.pieces.library
    ids = [[1, 230, 3, 2], [0, 264, 13], [], None, [259, 259, 264]]
    frame = spark.createDataFrame(list(enumerate(ids)), "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in pieces.decode(frame, MODEL).collect()}
    assert got == {k: lib.decode(i or []) for k, i in enumerate(ids)}

"""Operators 7 and 9 against the tokenizer libraries and exact round trips."""

import hashlib
import zlib

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF
from tidemark.llm import bpe, token_files
from tidemark.llm.queries import QUERIES
from tidemark.llm.word_encoder import ChunkEncoder, load

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path(bpe.RANKS)
AWKWARD = ["", " ", "  ", "a ", " a", "a \n b", "x\n\n b", "　 x", "a  b  ", "\n ", "a   b", "\0a b", "a \0a", "it's we'LL don’t",
           "a\nb", "\na", "a\n", "a.\nB c,\nd", "a  b\nc\n\nd e\nf", "x \ny", "x\n y\nz", "a\n\n\n", "w" * 90 + ", " + "w" * 90, "<|endoftext|>", "naïve 漢字 🙂🙂", "١٢٣ ½", "﻿abc᠎ d",
           "x \xa0 \xa0", "a \xa0 \xa0 b", "foo \xa0 \xa0 \xa0 bar", "a\xa0b c\xa0", "a\xa0 b", "x\u180e \u180e y", "p\x1c \x1cq\n\x85r"]


def plain():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t


def test_chunked_encoding_is_the_librarys():
    enc, tok = ChunkEncoder(load(JSON), 8), plain()
    for texts in (AWKWARD, AWKWARD[::-1], AWKWARD):
        flat, counts = enc.encode(texts)
        parts = np.split(flat, np.cumsum(counts)[:-1])
        assert [p.tolist() for p in parts] == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    enc.encode(["one  two " * 50, "v" * 100])
    assert all(len(w) <= 65 and "  " not in w for w in enc.at)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet="ab '\n\n\t  1,.é漢　s", max_size=40), max_size=4))
def test_chunked_encoding_of_random_texts(texts):
    tok = _shared()[1]
    flat, counts = _shared()[0].encode(texts)
    assert flat.tolist() == [i for e in tok.encode_batch(texts, add_special_tokens=False) for i in e.ids]
    assert counts.sum() == len(flat)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.text(alphabet="ab, \n\t\r\xa0\x85\x1c\u2003\u3000\u180e", max_size=30), max_size=4))
def test_chunked_encoding_of_mixed_white_space(texts):
    test_chunked_encoding_of_random_texts.hypothesis.inner_test(texts)


def _shared(cache=[]):  # noqa: B006
    if not cache:
        cache.extend([ChunkEncoder(load(JSON)), plain()])
    return cache


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=3000), st.sampled_from([(0.0,), (0.5,), (0.9,), (1.0,), token_files.PERCENTILES]))
def test_pack_round_trip(ids, percentile):
    ids = np.array(ids, np.uint32)
    low, width, exceptions, first, body = token_files.pack(ids, percentile)
    assert token_files.unpack(low, width, exceptions, first, body, len(ids)).tolist() == ids.tolist()


def files_by_hand(rows):
    tok, out, start = plain(), [], 0
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_op7_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = sorted(map(tuple, QUERIES["op7_token_files"](spark, SF).collect()))
    assert got == files_by_hand(rows)


def test_op7_odd_rows_and_small_shards(spark, odd_docs, no_docs):
    assert token_files.encode_to_files(no_docs, JSON).count() == 0
    got = sorted(map(tuple, token_files.encode_to_files(odd_docs, JSON, shard_ids=10).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, None, 1, 1, 2, 3, 4, 5, 6]
    order = sorted((r["doc_id"] is not None, r["doc_id"], r["text"] or "") for r in odd_docs.collect() if r["doc_id"] is not None)
    assert got[2:] == [(d, s + got[2][1], n, c) for d, s, n, c in files_by_hand([(o[1], o[2]) for o in order])]


def test_op7_ids_are_the_unchanged_librarys(spark):
    tok, enc = Tokenizer.from_file(JSON), ChunkEncoder(load(JSON), 8, special_as_text=False)
    texts = [*AWKWARD, "a <|endoftext|> b", "one\ntwo <|endoftext|>three  four\nfive", "<|endoftext|><|endoftext|>", "<|endoftext", "a <|endoftext|> b"]
    for _ in range(2):
        flat, counts = enc.encode(texts)
        parts = np.split(flat, np.cumsum(counts)[:-1])
        assert [p.tolist() for p in parts] == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
    assert parts[len(AWKWARD)].tolist() == [64, 220, 50256, 275]
    want, start = [], 0
    for d, t in enumerate(texts):
        ids = tok.encode(t, add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(map(tuple, token_files.encode_to_files(docs, JSON).collect())) == want


def test_op9_equals_tiktoken_and_round_trips(spark, odd_docs, no_docs):
    ranks = bpe.rank_table(RANKS)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def want(d, t):
        ids = enc.encode_ordinary(t or "")
        return (d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())

    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, QUERIES["op9_byte_bpe"](spark, SF).collect())) == sorted(want(*r) for r in rows)
    described = bpe.described_ranks(spark, RANKS)
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    encoded = bpe.encode(odd_docs, described)
    got = bpe.digests(bpe.decode(encoded, described)).collect()
    assert sorted(map(tuple, got), key=key) == sorted((want(r["doc_id"], r["text"]) for r in odd_docs.collect()), key=key)
    trip = bpe.digests(bpe.round_trip(odd_docs, described)).collect()
    assert sorted(map(tuple, trip), key=key) == sorted(map(tuple, got), key=key)
    assert bpe.decode(bpe.encode(no_docs, described), described).count() == bpe.round_trip(no_docs, described).count() == 0
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(described.value)
    for one in bpe.encode(spark.createDataFrame([(i, t) for i, t in enumerate([*AWKWARD, "é 漢🙂 ok"])], "doc_id long, text string"), described).collect():
        e = tok.encode([*AWKWARD, "é 漢🙂 ok"][one["doc_id"]], add_special_tokens=False)
        assert (one["ids"], list(zip(one["starts"], one["ends"]))) == (e.ids, e.offsets)
    back = bpe.decode(encoded, described).select("text").collect()
    assert sorted(r["text"] for r in back) == sorted(r["text"] or "" for r in odd_docs.collect())


def test_decode_of_broken_characters(spark):
    described = bpe.described_ranks(spark, RANKS)
    one = bpe.encode(spark.createDataFrame([(1, "漢")], "doc_id long, text string"), described).first()["ids"]
    frame = spark.createDataFrame([(1, one), (2, [one[0], 32]), (3, None)], "doc_id long, ids array<int>")
    text = {r["doc_id"]: r["text"] for r in bpe.decode(frame, described).collect()}
    assert text[1] == "漢" and text[3] == ""

"""The pipeline, stage by stage, against brute force on small tables."""

import hashlib
import os

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF
from test_models import matches_by_hand
from test_near import group, set_of
from test_scans import base_spans
from tidemark.llm import blob_ledger, bpe, templates, toxicity
from tidemark.llm.common import fold, no_rows, shared_folder

STAGE = dict(corpus_pipeline.STAGES)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "text").collect()), key=str)


def one_of_each(rows):
    sets = [set_of(t) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, set()).add(i)
    pairs = {(a, b) for hs in holders.values() for a in hs for b in hs if a > b}
    root = group(len(rows), [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])])
    key = lambda i: (rows[i][0] is None, rows[i][0] or 0, hashlib.sha256((rows[i][1] or "").encode()).hexdigest())
    first = {}
    for i, r in enumerate(root):
        first[r] = min(first.get(r, i), i, key=key)
    return sorted((rows[i] for i in range(len(rows)) if not sets[i] or first[root[i]] == i), key=str)


def encoded_by_hand(rows):
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.rank_table(P.path(bpe.RANKS)), special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    ids = [(d, enc.encode_ordinary(t or ""), t or "") for d, t in rows]
    return sorted(((d, len(i), sha(np.array(i, "<u4").tobytes()), sha(t.encode())) for d, i, t in ids), key=str)


def test_every_stage_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), fold("doc_id", 5) != 0)
    at = rows_of(docs)
    clean = STAGE["toxicity"](spark, docs, SF)
    at = [r for r, s in zip(at, model.scores([t for _, t in at])) if s < 0.5]
    assert clean.columns == docs.columns and rows_of(clean) == at
    unique = STAGE["near_duplicates"](spark, clean, SF)
    at = one_of_each(at)
    assert unique.columns == docs.columns and rows_of(unique) == at
    items = list(map(tuple, spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()))
    tested = STAGE["decontamination"](spark, unique, SF)
    leaks = {d for (d, _), c in matches_by_hand(at, items).items() if c >= 0.75}
    at = [r for r in at if r[0] not in leaks]
    assert tested.columns == docs.columns and rows_of(tested) == at
    masked = STAGE["secrets"](spark, tested, SF)
    assert masked.columns == docs.columns and masked.dtypes == docs.dtypes
    got = dict(rows_of(masked))
    assert len(got) == len(at)
    for d, t in at:
        if not base_spans(t):
            assert got[d] == t
        else:
            want = t
            for start, _, end, _ in reversed(base_spans(t)):
                want = want[:start] + "[secret]" + want[end:]
            assert got[d] == want
    assert masked.where(F.col("n_chars") != F.length("text")).count() == docs.where(F.col("n_chars") != F.length("text")).count() == 0
    assert sorted(map(tuple, STAGE["tokens"](spark, masked, SF).collect()), key=str) == encoded_by_hand(list(got.items()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()), key=str) == encoded_by_hand(list(got.items()))


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            assert out.count() <= docs.count()
    kept = rows_of(STAGE["near_duplicates"](spark, odd_docs, SF))
    assert [t for _, t in kept].count("plain words here") == 1 and len(kept) == 7


@pytest.mark.parametrize("stage", ["decontamination", "near_duplicates", "secrets"])
def test_clean_documents_stay(spark, stage):
    texts = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(30)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert rows_of(STAGE[stage](spark, docs, SF)) == rows_of(docs)


def test_run_on_empty_tables(spark):
    folder = shared_folder(spark, "empty-tables").removeprefix("file://")
    os.makedirs(folder)
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").where("false").write.parquet(f"{folder}/{t}.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_a_task_has_one_python_worker(spark, odd_docs):
    """A second Python step in one stage would double the workers that an executor keeps through all later stages."""
    found = templates.contaminated(odd_docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert found._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_empty_tables_start_no_python(spark, odd_docs, monkeypatch):
    empty = no_rows(spark, blob_ledger.SCAN_SCHEMA)
    assert empty.dtypes == spark.createDataFrame([], blob_ledger.SCAN_SCHEMA).dtypes and empty.collect() == []
    assert no_rows(spark, "a long, b string").dtypes == [("a", "bigint"), ("b", "string")]

    def refuse(*args, **kwargs):
        raise AssertionError("createDataFrame of Python rows runs in a Python daemon of its own")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    assert STAGE["near_duplicates"](spark, odd_docs, SF).count() == 7
    assert STAGE["secrets"](spark, odd_docs, SF).count() == odd_docs.count()


def test_rejected_documents_are_told_by_short_keys(spark, monkeypatch):
    """16 bytes stand for a text, so that the rejected ones can be broadcast and no text is shuffled for them."""
    seen = []

    def staged(df, name, write=corpus_pipeline.staged):
        out = write(df, name)
        if name == "rejected":
            seen.extend(len(r["__key"]) for r in out.collect())
        return out

    monkeypatch.setattr(corpus_pipeline, "staged", staged)
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (None, "a"), (2, None), (None, None)], "doc_id long, text string")
    key = F.sha2(F.coalesce("text", F.lit("")), 256)
    gone = docs.where("doc_id IS NULL OR text = 'b'").select("doc_id", key.alias("key"))
    left = corpus_pipeline._without(docs, gone, key).collect()
    assert sorted(map(tuple, left), key=str) == [(1, "a"), (2, None)] and seen == [16, 16, 16]

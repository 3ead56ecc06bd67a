"""Operators 2, 3, 6 and 8 against brute force, planted cases and odd rows."""

import hashlib
import itertools
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF
from tidemark.llm import blob_ledger, license_index, toxicity, url_filter
from tidemark.llm.common import fold, shared_folder
from tidemark.llm.queries import QUERIES

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    t = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def digest(text):
    spans = base_spans(text)
    joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
    return *(sum(x[3] == k for x in spans) for k in blob_ledger.BASE), hashlib.sha256(joined.encode()).hexdigest()


HARD = ["token:token:abcdefg", "🙂 token=secret=abcdef1 x", "AKIAAKIA" + "B" * 16, "a" * 23 + "g" + "b" * 24 + " " + "0" * 30,
        "PassWord = 'abc.def-'; passwd:x", "ghp_" + "a" * 36 + " ftp://u:pw@host", "secret:\ttabbed1", "API_KEY=\"Zm9vYmFy=\""]


def test_op6_whole_table_and_hard_texts(spark, odd_docs, no_docs):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:5] for r in QUERIES["op6_blob_ledger"](spark, SF).collect()}
    assert got == {r["doc_id"]: digest(r["text"]) for r in rows}
    hard = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    for docs, want in ((hard, HARD), (odd_docs, [r["text"] for r in odd_docs.collect()])):
        ledger = blob_ledger.update(docs, shared_folder(spark, "ledger"))
        out = blob_ledger.summary(blob_ledger.report(docs, ledger)).collect()
        assert sorted(tuple(r)[1:5] for r in out) == sorted(map(digest, want))
    kinds = " ".join(r["spans"] for r in blob_ledger.summary(blob_ledger.report(hard, blob_ledger.update(hard, shared_folder(spark, "l")))).collect())
    assert "github:0:40" in kinds and "url_login:" in kinds
    assert blob_ledger.report(no_docs, blob_ledger.update(no_docs, shared_folder(spark, "ledger"))).count() == 0


def test_op6_only_unseen_pairs_are_scanned(spark):
    docs = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    folder, rules = shared_folder(spark, "ledger"), blob_ledger.RULES
    first = docs([(1, "token=abcdef1"), (2, "token=abcdef1"), (3, "none")])
    assert blob_ledger.update(first, folder).count() == 2
    second = docs([(4, "none"), (5, "AKIA" + "A" * 16), (1, "token=abcdef1")])
    pending = blob_ledger.scan(second, blob_ledger.read_ledger(second, folder))
    assert [r["found"][0]["kind"] for r in pending.collect()] == ["access"]
    assert blob_ledger.update(second, folder).count() == 3
    newer = (blob_ledger.Rule("assign", rules[0].pattern, 2, 3, rules[0].hints, version=2), *rules[1:])
    again = blob_ledger.scan(second, blob_ledger.read_ledger(second, folder), newer).collect()
    assert len(again) == 3 and all(r["rules"] == ["assign@2"] for r in again)
    found = {r["doc_id"]: len(r["found"]) for r in blob_ledger.report(first, blob_ledger.read_ledger(first, folder)).collect()}
    assert found == {1: 1, 2: 1, 3: 0}


def test_op6_query_scans_unseen_pairs_only(spark):
    """Both loads of the query: what did not change is scanned again by the changed rules alone."""
    from tidemark.llm.common import shared_folder
    from tidemark.llm.queries import ledger_of_two_loads

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pairs = blob_ledger.scanned_pairs(ledger_of_two_loads(docs, shared_folder(spark, "test-ledger")))
    assert pairs.count() == pairs.distinct().count()
    rules = {r.key for r in blob_ledger.RULES} | {r.key for r in blob_ledger.EARLIER_RULES}
    held = {(r["blob"], r["rule"]) for r in pairs.collect()}
    texts = {(r["text"] or "", r["lang"]) for r in docs.collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    old = {sha(t if lang == "en" else t[:-1]) for t, lang in texts}
    new = {sha(t) for t, _ in texts}
    assert held == {(b, k) for b in old for k in rules if b in new or not k.endswith("@1") or k.split("@")[0] not in ("google", "slack")} | {
        (b, k) for b in new - old for k in rules if k.endswith("@1")}


def test_op6_redact(spark):
    docs = spark.createDataFrame([(1, "🙂 token=abcdef1 and AKIA" + "A" * 16 + "."), (2, "clean")], "doc_id long, text string")
    found = blob_ledger.report(docs, blob_ledger.update(docs, shared_folder(spark, "ledger"))).withColumnRenamed("doc_id", "d")
    out = docs.join(found, docs.doc_id == found.d).select("doc_id", blob_ledger.redact(F.col("text"), F.col("found")).alias("t"))
    assert {r["doc_id"]: r["t"] for r in out.collect()} == {1: "🙂 [secret] and [secret].", 2: "clean"}


PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def license_by_hand(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, k) for k, p in PHRASES.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(ws), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({k for _, k in places}))


def test_op8(spark, odd_docs, no_docs):
    extra = ["Under  the MIT-license under the mit license", "cc by nc cc by nc", "the mit", "Apache License, Version 2.0, under the İ mit license",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
             "files (the Software), to deal in this Software without restriction"]
    docs = spark.createDataFrame(list(enumerate(extra)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in license_index.summary(license_index.scan(docs)).collect()}
    assert all(tuple(out[i])[1:6] == license_by_hand(t) for i, t in enumerate(extra))
    assert out[4]["labels"] == "mit" and out[4]["base_labels"] == "" and 0.9 < out[4]["score"] < 1
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r)[1:6] for r in QUERIES["op8_license_index"](spark, SF).collect()}
    assert got == {r["doc_id"]: license_by_hand(r["text"]) for r in rows}
    odd = license_index.summary(license_index.scan(odd_docs)).collect()
    assert sorted(r["n_words"] for r in odd) == sorted(license_by_hand(r["text"])[0] for r in odd_docs.collect())
    assert license_index.scan(no_docs).count() == 0


def test_op2_transducers():
    g = toxicity.Grammar({"idiot": 3.0, "lowe*": 2.0})
    names = [*toxicity.KINDS, "all", "clauses", "rate", "most"]
    f = lambda t: {k for k, v in zip(names, g.features(t)) if v and k in toxicity.KINDS}
    assert f("an idiot walks") == {"I"} and f("loweix da") == {"I"}
    assert f("he is not an idiot") == {"i"} and f("not one of the other idiot words") == {"I"}
    assert f("it said: fine. idiot") == {"I"} and f("mary wrote idiot") == {"q"} and f("mary said not idiot") == {"k"}
    assert f("you idiot") == {"J"} and f("i will kill") == {"T"} and f("not you. kill you") == {"T"} and f("you we kill") == {"A"}
    assert f("") == f(None) == f("nothing here") == set()


def test_op2_grammar_over_clauses():
    g = toxicity.Grammar({"idiot": 3.0})
    f = lambda t: {k for k, v in zip(toxicity.KINDS, g.features(t)) if v}
    assert f("idiot, you") == {"J"} and f("an idiot of the worst sort, you") == {"I"}
    assert f("he isn't an idiot") == f("he isn’t an idiot") == f("he isnt an idiot") == {"i"}
    assert f("the man said: you idiot") == f("the man said:\nyou idiot") == f("the man said\nyou idiot") == {"q"}
    assert f('he said: "fine. idiot" and left. idiot') == {"q", "I"} and f("he said “fine. idiot”") == {"q"} and f("he said: fine\nidiot") == {"I"}
    assert f("the hearts beat, they shoot a film and burn wood") == set() and f("he beat the record") == set()
    assert f("i'll burn you") == f("we will beat them up") == f("kill him") == {"T"} and f("ich werde dich schlagen") == {"A"}
    assert f("i won't hurt you") == {"t"} and f("she said: we will kill you") == f("she said: kill him") == {"r"}


def test_op2_learns_words_that_clean_texts_negate_or_quote(spark):
    rows = [(f"you are a fool number {'abcdefgh'[i % 8]}", 1) for i in range(40)] + [(f"he is no fool at all {'abcdefgh'[i % 8]}", 0) for i in range(40)]
    rows += [("my boss said: what a fool", 0), ("what a rare dolt", 1)] * 6 + [("the weather is fine", 0)] * 60
    frame = spark.createDataFrame(rows, "text string, label int")
    found = toxicity.learn_lexicon(frame)
    assert "fool" in found and found["fool"] > 3 and not {"weather", "boss"} & set(found)


def test_op2_fits_threats_without_a_lexicon(spark):
    threats = [f"{w} {v} go home {a}{b}" for w in ("we will", "i will") for v in ("kill you", "hurt them") for a in "abcdefgh" for b in "klmnopqr"]
    rows = [(i, t, 1) for i, t in enumerate(threats)]
    rows += [(1000 + i, f"home we go you them will i {a}{b} {c}", 0) for i, (a, b, c) in enumerate((a, b, c) for a in "abcdefgh" for b in "klmnopqr" for c in "stuv")]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    import unittest.mock as mock

    with mock.patch.object(toxicity, "learn_lexicon", lambda rows: {}):
        model = toxicity.train(docs, labels, F.lit(True))
    assert (model.scores(["i will kill you", "go home"]) >= 0.5).tolist() == [True, False]


def test_op2_learns_from_training_folds_only(spark, odd_docs, no_docs):
    base = "/root/testdata/sf0.01"
    scored = QUERIES["op2_toxicity"](spark, base).join(spark.read.parquet(f"{base}/labels.parquet"), "doc_id")
    n = {(r["toxic"], r["predicted"]): r["count"] for r in scored.where("held_out").groupBy("toxic", "predicted").count().collect()}
    right = n.get((0, 0), 0) + n.get((1, 1), 0)
    assert right / sum(n.values()) > 0.95 and n.get((1, 1), 0) > 0 and n.get((0, 1), 0) == 0
    labels = spark.createDataFrame([(1, 1), (4, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    model = toxicity.train(odd_docs, labels, fold("doc_id", 5) != 9)
    assert toxicity.scored(odd_docs, model, name="tox").count() == 9
    assert toxicity.scored(no_docs, toxicity.train(no_docs, labels, F.lit(True)), name="tox").count() == 0


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def rule_by_hand(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.split("[/?#]", rest, maxsplit=1)[0] if rest else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_op3(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/en/12?x=1", "http://example.org/es/a#b", "http://org", "http://borg/x",
            "https://cheappills.example.net/buy", "https://free-bets.example.net/en/3.html", "http://a.com/fr/?u=://x", "http://ththre.example.net/en/2"]
    rows = [(i, u, "<p>the cheap thing there</p><script>var pills</script>") for i, u in enumerate(urls)] + [(None, urls[5], None), (0, urls[5], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"n": F.lit(1), "word": F.lit("w")})
    out = url_filter.judged(pages).collect()
    assert len(out) == len(rows)
    for r in out:
        u = rows[r["page_id"]][1] if r["page_id"] else None
        if u is not None:
            host, path, rule, verdict = rule_by_hand(u)
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ("allow", "block")
            assert verdict is None or r["verdict"] == verdict
    got = {r["page_id"]: r for r in out}
    assert got[8]["host_words"][:2] == ["cheap", "pills"] and got[8]["verdict"] == got[9]["verdict"] == "block"
    assert got[11]["verdict"] == "allow"
    assert url_filter.judged(pages.where("false")).count() == 0


def test_op3_whole_table(spark):
    """Rules by hand, then naive Bayes by hand over the host words that the query's operator returns."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = {r["page_id"]: r["url"] for r in pages.collect()}
    found = url_filter.judged(pages).collect()
    bags = {}
    for r in found:
        words = re.findall(r"[^\W_]+", r["path"].lower())
        bags[r["page_id"]] = ([f"h:{w}" for w in r["host_words"]] + ["p:" + ("#" if w.isnumeric() else w) for w in words], any(w in url_filter.SEEDS for w in r["host_words"]))
    counts = {True: Counter(), False: Counter()}
    for bag, blocked in bags.values():
        counts[blocked].update(bag)
    vocabulary = len(set(counts[True]) | set(counts[False]))
    total = {c: sum(n.values()) for c, n in counts.items()}
    n_blocked = sum(b for _, b in bags.values())
    likely = lambda t, c: math.log((counts[c][t] + 1) / (total[c] + vocabulary + 1))
    assert 0 < n_blocked < len(bags)
    seen = set()
    for r in found:
        host, path, rule, verdict = rule_by_hand(rows[r["page_id"]])
        bag, _ = bags[r["page_id"]]
        score = math.log((n_blocked + 1) / (len(bags) - n_blocked + 1)) + sum(likely(t, True) - likely(t, False) for t in bag)
        assert r["score"] == pytest.approx(score)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] == (verdict or ("block" if score > 0 else "allow"))
        seen.add((rule, r["verdict"]))
    assert {(None, "block"), (None, "allow")} & seen
    got = QUERIES["op3_url_filter"](spark, SF).select("page_id", "verdict").collect()
    assert sorted(map(tuple, got)) == sorted((r["page_id"], r["verdict"]) for r in found)


def test_op3_words_of_any_length_and_table_size(spark):
    long = "donaudampfschifffahrtsgesellschaftskapitaen"
    urls = [f"http://billig{long}.example.net/x", f"http://{'q' * 3000}{long}casino.com/{'y' * 9000}", f"http://{long[:30]}.net/"]
    rows = [(i, u, f"<p>{long} billig {long}x</p>") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    words = {r["page_id"]: r["host_words"] for r in url_filter.judged(pages).collect()}
    assert words[0][:2] == ["billig", long] and words[1] == ["q" * 3000, long, "casino", "com"] and words[2] == [long[:30], "net"]
    many = spark.range(40).crossJoin(pages).select((F.col("id") * 10 + F.col("page_id")).alias("page_id"), "url", "html")
    again = {(r["page_id"] % 10, tuple(r["host_words"])) for r in url_filter.judged(many).collect()}
    assert again == {(k, tuple(v)) for k, v in words.items()}


@pytest.mark.parametrize("piece", ["thethere", "abxthe", "qq", "a", "xxthexx", "therea"])
def test_op3_viterbi_is_optimal(piece):
    counts, total = {"the": 50, "there": 20, "re": 5, "a": 9, "b": 2}, 100

    def cost(parts):
        return sum(math.log(total / counts[p]) if p in counts else math.log(total + 1) + len(p) * math.log(10) for p in parts)

    splits = [[piece[a:b] for a, b in itertools.pairwise((0, *cut, len(piece)))] for k in range(len(piece))
              for cut in itertools.combinations(range(1, len(piece)), k)]
    assert cost(url_filter.viterbi(piece, counts, total)) == pytest.approx(min(map(cost, splits)))

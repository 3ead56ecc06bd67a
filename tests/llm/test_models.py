"""Operators 1 and 4 against direct computations on small inputs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from tidemark.llm import templates, tree_weighting as tw
from tidemark.llm.queries import QUERIES


END = bytes([tw.END])


def body(text):
    return b" ".join((text or "").encode().lower().split()) + END


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


class Direct:
    """Context-tree weighting by recursion over all contexts of one node, from the definition."""

    def __init__(self, bodies, depth):
        self.depth, self.n = depth, Counter()
        for b in bodies:
            s = END * depth + b
            for i in range(depth, len(s)):
                for k in range(8):
                    for d in range(depth + 1):
                        self.n[s[i - d : i], (1 << k) | (s[i] >> (8 - k)), (s[i] >> (7 - k)) & 1] += 1
        self.longer = {}
        for c, node, _ in self.n:
            if c:
                self.longer.setdefault((c[1:], node), set()).add(c)

    def pw(self, c, node):
        pe = kt(self.n[c, node, 0], self.n[c, node, 1])
        return pe if len(c) == self.depth else math.log(0.5) + np.logaddexp(pe, sum(self.pw(x, node) for x in self.longer.get((c, node), ())))

    def one(self, context, node, d=0):
        c = context[len(context) - d :]
        a, b = self.n[c, node, 0], self.n[c, node, 1]
        if not a + b:
            return None
        p = (b + 0.5) / (a + b + 1)
        deeper = self.one(context, node, d + 1) if d < self.depth else None
        if deeper is None:
            return p
        w = math.exp(math.log(0.5) + kt(a, b) - self.pw(c, node))
        return w * p + (1 - w) * deeper

    def score(self, b):
        s, out = END * self.depth + b, 0.0
        for i in range(self.depth, len(s)):
            for k in range(8):
                p = self.one(s[i - self.depth : i], (1 << k) | (s[i] >> (8 - k)))
                p = 0.5 if p is None else p
                out += math.log10(p if (s[i] >> (7 - k)) & 1 else 1 - p)
        return out


def base_by_hand(rows):
    """rows: (text, training); words by pattern."""
    toks = [re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None] for t, _ in rows]
    c = Counter(w for (_, tr), ws in zip(rows, toks) if tr for w in ws)
    n, v = sum(c.values()), len(c)
    return [(len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for ws in toks]


TEXTS = ["the cat sat on the mat", "The cat  ate\tthe rat", "the the the", "", None, "naïve cat", "zebra cats", "the cat sat on the mat"]


@pytest.mark.parametrize("blocks", [10**9, 20])
def test_op1_is_context_tree_weighting(spark, blocks):
    rows = [(i, t, i not in (1, 6)) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tr boolean").withColumns({"id": F.lit(1), "score": F.lit(2), "sha": F.lit("x"), "n": F.lit(3)})
    got = {r["doc_id"]: r for r in tw.scored(docs, F.col("tr"), depth=3, block_bytes=blocks, bucket_bytes=blocks).collect()}
    bodies = [body(t) for t in TEXTS]
    direct = Direct([b for b, r in zip(bodies, rows) if r[2]], 3)
    for (i, *_), b, want in zip(rows, bodies, base_by_hand([r[1:] for r in rows])):
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert r["base_score"] == pytest.approx(want[3]) and r["score"] == pytest.approx(direct.score(b), rel=1e-9)


def test_op1_bytes_are_a_distribution():
    g, n = np.unique(tw.grams([(t or "").encode() for t in TEXTS])[0], return_counts=True)
    upper, low = tw.upper_tree(g, n)
    lower = tw.lower_tree(*low)
    for context in (b"e cat", b"\n\n\n\n\n", b"qqqqq", b"aacat"):
        c = np.uint64(int.from_bytes(context, "big"))
        p = 10 ** tw.log10_probabilities((c << np.uint64(8)) | np.arange(256, dtype=np.uint64), lower, upper)
        assert p.sum() == pytest.approx(1)


def test_op1_grams():
    want = []
    for t in TEXTS:
        s = END * 5 + body(t)
        want += [int.from_bytes(s[i - 5 : i + 1], "big") for i in range(5, len(s))]
    own, sizes, _ = tw.grams([(t or "").encode() for t in TEXTS])
    assert own.tolist() == want and sizes.tolist() == [len(body(t)) for t in TEXTS]


def test_op1_log_gamma():
    z = np.array([0.5, 1, 1.5, 7, 100.5, 1e7])
    assert tw.log_gamma(z) == pytest.approx([math.lgamma(x) for x in z], rel=1e-10, abs=1e-10)


def test_op1_beats_the_base_on_held_out_texts(spark):
    held = QUERIES["op1_tree_weighting"](spark, "/root/testdata/sf0.1").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_op1_whole_table(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("crc")).collect()
    got = {r["doc_id"]: r for r in QUERIES["op1_tree_weighting"](spark, SF).collect()}
    base = base_by_hand([(r["text"], r["crc"] % 10 != 0) for r in rows])
    for r, want in zip(rows, base):
        g = got[r["doc_id"]]
        assert g["held_out"] == (r["crc"] % 10 == 0) and (g["n_tokens"], g["n_known"], g["train_tokens"]) == want[:3]
        assert g["base_score"] == pytest.approx(want[3])
    assert len(got) == len(rows)


def test_op1_odd_rows(spark, odd_docs, no_docs):
    assert tw.scored(odd_docs, F.lit(True)).count() == 9
    assert tw.scored(no_docs, F.lit(True)).count() == 0
    alone = tw.scored(odd_docs, F.lit(False)).collect()
    assert all(r["n_known"] == 0 and r["bits_per_byte"] == pytest.approx(8) for r in alone)


# ---------------------------------------------------------------- operator 4

WORDS = re.compile(r"[^\W_]+")


def template_by_hand(text, form):
    """Template tokens with their slot values, word by word."""
    out = []
    for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", text or ""):
        low, kind = w.lower(), None
        if w[0].isdigit() or low in templates.NUMBER_WORDS:
            kind = "num"
        elif low in templates.UNITS and out and out[-1][2] == "num":
            kind = "unit"
        elif w[0].isupper() and low not in templates.UNITS and form == "typed":
            kind = "name"
        if kind in ("num", "name") and out and out[-1][2] == kind:
            out[-1][1] += " " + w
        else:
            out.append([low if kind is None else f"<{kind}>", w, kind])
    return out


def windows_by_hand(text, form):
    """[(key, slots, first token is a slot, last one is)] of every place."""
    t = template_by_hand(text, form)
    spans = [t[i : i + 5] for i in range(len(t) - 4)] or ([t] if t else [])
    out = []
    for s in spans:
        key = (len(s),) + tuple(x[0] for x in s)
        if len(s) < 5 and all(x[2] for x in s):
            key += tuple(x[1].lower() for x in s)
        out.append((key, [x[1].lower() for x in s if x[2]], bool(s[0][2]), bool(s[-1][2])))
    return out


def inside_by_hand(x, y, left, right):
    """The parts of two runs that a passage which begins or ends in them holds."""
    x, y = x.split(), y.split()
    k = min(len(x), len(y))
    if left and right:
        if any((x if len(y) == k else y)[i:][:k] == (y if len(y) == k else x) for i in range(max(len(x), len(y)) - k + 1)):
            return (y, y) if len(y) == k else (x, x)
        return x, y
    return (x[len(x) - k :], y[len(y) - k :]) if left else (x[:k], y[:k])


def kept_by_hand(passage):
    """The item places of a diagonal's windows that count, from {place: (item slots, slots, lead, tail)}."""
    votes, judged = {}, []
    for p, (own, slots, lead, tail) in sorted(passage.items()):
        pairs = []
        for j, (x, y) in enumerate(zip(own, slots)):
            left, right = j == 0 and lead and p - 1 not in passage, j == len(own) - 1 and tail and p + 1 not in passage
            same, may = x == y, {y}
            if not same and (left or right):
                u, v = inside_by_hand(x, y, left, right)
                same, may = u == v, {y, " ".join(v)}
            for value in [x] if same else may:
                votes.setdefault(x, []).append(value)
            pairs.append((x, same, may))
        judged.append((p, pairs))
    winner = {x: sorted(set(v), key=lambda y: (-v.count(y), y != x, y))[0] for x, v in votes.items()}
    return {p for p, pairs in judged if all(s for _, s, _ in pairs) or all(winner[x] in may or (s and winner[x] == x) for x, s, may in pairs)}


def matches_by_hand(docs, items):
    out = {}
    described = {(form, i): windows_by_hand(item, form) for form in templates.FORMS for i, item in items}
    for d, text in docs:
        spoken = " " + " ".join(w.lower() for w in re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", text or "")) + " "
        for form in templates.FORMS:
            at = {}
            for p, (w, *rest) in enumerate(windows_by_hand(text, form)):
                at.setdefault(w, []).append((p, rest[0]))
            for i, item in items:
                own = described[form, i]
                if own and own[0][0][0] < 5 and f" {' '.join(x.lower() for x in re.findall(r'[0-9A-Za-z\x80-\U0010ffff]+', item))} " in spoken:
                    out[d, i] = 1.0
                iw = {}
                for p, (w, *rest) in enumerate(own):
                    iw.setdefault(w, (p, *rest))
                diagonals = {}
                for w, (q, slots, lead, tail) in iw.items():
                    for p, theirs in at.get(w, ()):
                        diagonals.setdefault(p - q, {})[q] = (slots, theirs, lead, tail)
                hits = set().union(*map(kept_by_hand, diagonals.values()))
                if hits and len(hits) / len(iw) > out.get((d, i), 0):
                    out[d, i] = len(hits) / len(iw)
    return out


ITEMS = [(1, "Alice buys 3 apples and Bob eats 3 apples while 12 kg of flour cost 7 dollars in all"),
         (2, "the quick brown fox jumps over the lazy dog again and again until night falls"), (3, "two words"), (4, None), (5, ""),
         (6, "the quick brown fox jumps over the lazy dog again and again until night falls")]
DOCS = [(1, "Note: Carla buys 5 apples and John Smith eats 5 apples while 40 kg of flour cost 9 dollars in all. End"),
        (2, "Carla buys 5 apples and John eats 6 apples while 40 kg of flour cost 9 dollars in all"),
        (3, "THE QUICK BROWN fox jumps, over the lazy dog again and again until night falls"), (4, "five words"), (5, "he said two words to me today"),
        (6, None), (7, ""), (8, "the quick brown fox jumps over the lazy dog"), (None, "the quick brown fox jumps over the lazy dog again and again until night"),
        (3, "THE QUICK BROWN fox jumps, over the lazy dog again and again until night falls"),
        (9, "so the quick brown fox jumps over the very lazy dog again and again until night falls " + "and more of it " * 3000)]


@pytest.mark.parametrize("bits", [1 << 27, 64])
def test_op4_against_direct_matching(spark, monkeypatch, bits):
    monkeypatch.setattr(templates, "BITS_MOST", bits)  # a full bitmap lets everything through, the rows are the same
    monkeypatch.setattr(templates, "BITS_LEAST", 64)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumns({"id": F.lit(1), "key": F.lit(2), "n": F.lit(3), "form": F.lit("f")})
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("hash", F.lit(1))
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in templates.matches(docs, items).collect()}
    assert got == pytest.approx(matches_by_hand(DOCS, ITEMS))
    leaks = {(r["doc_id"], r["item_id"]): r["exact"] for r in templates.contaminated(docs, items).collect()}
    assert leaks == {(1, 1): False, (2, 1): False, (5, 3): True, (3, 2): True, (3, 6): True, (4, 3): False, (None, 2): True, (None, 6): True}


def test_op4_whole_table_and_empty(spark, no_docs):
    docs = list(map(tuple, spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()))
    items = list(map(tuple, spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()))
    want = {k: v for k, v in matches_by_hand(docs, items).items() if v >= 0.75}
    got = {(r["doc_id"], r["item_id"]): r["coverage"] for r in QUERIES["op4_templates"](spark, SF).collect()}
    assert got == pytest.approx(want) and got
    planted = {(d, i) for d, t in docs for i, x in items if x in (t or "")}
    assert planted <= set(got)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert templates.matches(no_docs, bench).count() == 0 and templates.matches(bench.withColumnRenamed("item_id", "doc_id"), bench.where("false")).count() == 0


FRIENDS = "3 friends share a box of sweets and each of the 3 friends gets some"
PARTS = "the 4 red boxes hold 6 balls each and the 5 blue boxes hold 9 balls each so count them"
BY_WINDOW = [(1, f"Question 12. {FRIENDS}", {1}), (2, f"{FRIENDS} 7 more lines", {1}), (3, f"Question 12. {FRIENDS.replace('3', '8')}", {1}),
             (4, "so " + PARTS.replace("4", "7").replace("5", "7"), {2}), (5, "so " + PARTS.replace("6", "2", 1), {2}), (6, "3 friends share a box", set())]


def test_op4_drops_only_the_windows_that_disagree(spark):
    items = spark.createDataFrame([(1, FRIENDS), (2, PARTS)], "item_id long, text string")
    docs = spark.createDataFrame([r[:2] for r in BY_WINDOW], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in templates.contaminated(docs, items).collect()}
    assert {k: v['coverage'] for k, v in got.items()} == pytest.approx({k: v for k, v in matches_by_hand([r[:2] for r in BY_WINDOW], [(1, FRIENDS), (2, PARTS)]).items() if v >= 0.75})
    assert set(got) == {(d, i) for d, _, own in BY_WINDOW for i in own}
    assert got[1, 1]["coverage"] == 1 and got[1, 1]["exact"] and got[2, 1]["exact"] and not got[3, 1]["exact"]


SHORT = [(1, "What is 17 + 25 + 31?"), (2, "Who wrote Hamlet?"), (3, "two words"), (4, "17 + 4")]
HOLD_SHORT = [(1, "Quiz 9. What is 17 + 25 + 31? 12 people knew it, as we were told", {1}), (2, "In a quiz: Who wrote Hamlet? He did not know at all", {2}),
              (3, "what is 18 + 25 + 31 and who wrote Macbeth, they asked us", set()), (4, "he said Two words to me today", {3}), (5, "five words", {3}),
              (6, "they add 3, 17 + 4 and 9 to find it out", {4}), (7, "who wrote hamlet", {2}), (8, "what is 17 + 25, they asked all of us", set())]


def test_op4_finds_short_items_inside_documents(spark):
    items = spark.createDataFrame(SHORT, "item_id long, text string")
    docs = spark.createDataFrame([r[:2] for r in HOLD_SHORT], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["exact"] for r in templates.contaminated(docs, items).collect()}
    assert set(got) == {(d, i) for d, _, own in HOLD_SHORT for i in own} and all(e for (d, _), e in got.items() if d != 5)
    assert set(got) == {k for k, v in matches_by_hand([r[:2] for r in HOLD_SHORT], SHORT).items() if v >= 0.75}


def test_op4_an_item_of_numbers_costs_a_document_one_row(spark):
    """Slot values are part of what is joined: other numbers of a document don't become rows."""
    items = spark.createDataFrame([(1, "17"), (2, "18 kg")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "3 a 4 b 17 c 5 d 6 e 7"), (2, "19"), (3, "17"), (4, "18 KG")], "doc_id long, text string")
    rows = docs.select(F.col("doc_id").alias("id"), templates.text_key().alias("key"), "text")
    hashes = templates.windows(items.select(F.col("item_id").alias("id"), templates.text_key().alias("key"), "text"), once=True).select("hash").distinct()
    wanted = spark.sparkContext.broadcast(templates.bitmap(hashes))
    assert templates.windows(rows.where("id = 1"), wanted, phrases=(1, 2)).count() == 1
    assert {(r["doc_id"], r["item_id"]) for r in templates.contaminated(docs, items).collect()} == {(1, 1), (3, 1), (4, 2)}


def test_op4_random_texts(spark):
    rng = random.Random(3)
    text = lambda: " ".join(rng.choices("a b c 1 2 3 kg Bob Eve two".split(), k=rng.randint(1, 14)))
    items = [(i, text()) for i in range(60)]
    docs = list(enumerate([text() for _ in range(150)] + [f"{text()} {t} {text()}" for _, t in items]))
    got = templates.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]): r["coverage"] for r in got.collect()} == pytest.approx(matches_by_hand(docs, items))

"""Toxicity by a weighted finite-state grammar over clauses (operator 2).

Words become symbols: insult, verb of violence, target, negation, report verb, modal, speaker, other.  The
insult lexicon is learned: whole words and word beginnings that labelled toxic
texts hold far more often than clean ones, each with its log-odds as weight; the
other classes are short fixed lists.  Four small transducers are composed into
one machine that reads a clause, makes a threat of a verb in a threat's pattern
(:func:`threat`) and rewrites every insult or threat by its surroundings: negated
("not an idiot"), reported ("he said idiot"), aimed at a target before it ("you
idiot").  What follows a verb is seen by a transducer that reads the clause backwards
first, an insult aimed at a target after it ("idiot, you") by one that does so
last.  A report goes on after a colon, over a line end right behind its verb, and in
quotes up to their end or the line's.  A document's features are the summed
weights of each rewritten kind, its matched clauses and their part of all words;
a logistic regression turns them into a score.

Lexicon and regression are fitted on a bounded sample of labelled rows
(``sample`` rows, those with the smallest hash of the id), so the sample's ids
may be broadcast.  Of near copies in the sample, told by the least hash of their
word triples, one counts.  The lexicon comes from one half of the sample and the
regression from the other, so that chance finds of the lexicon get no credit.  An
occurrence counts for the lexicon if it is neither negated nor reported.  A lexicon
entry must stand in SUPPORT toxic texts of the sample and be e^LEAST_ODDS times as
frequent there, by two standard errors; the sample's texts bound the entries.
Labels, language, source and id are no inputs of a score.

Null and empty texts have no features and get the regression's base score; with
no labelled rows of both classes the lexicon is empty and every score is 0.  An empty
lexicon otherwise leaves the threats, on which the regression is fitted all the same.
Rows are scored one by one; repeated rows and null ids keep their rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

SAMPLE = 20_000
SUPPORT = 4
LEAST_ODDS = 0.5
STEMS = (4, 5, 6)

# Seed words of the classes that are not learned, in English, French, Spanish and German.
SEEDS = {
    "V": "kill hurt destroy burn beat shoot stab murder strangle tuer frapper matar golpear töten schlagen".split(),
    "U": "you your youre yourself he she they them him his her their these those tu toi vous tes usted ustedes ellos ella du dich dir ihr euch".split(),
    "N": "not no never none without cannot isnt arent dont doesnt didnt wasnt werent wont wouldnt shouldnt couldnt cant mustnt havent hasnt hadnt aint ne pas jamais nunca jamás sin nicht kein keine nie".split(),
    "R": "said says say wrote writes claimed called calls quoted according reported told dit écrit selon dijo según sagte schrieb laut".split(),
    "M": "will ll shall should must would could can may might gonna going want wanna let lets vais va vont voy vamos werde werden will muss".split(),
    "G": "i we je nous yo nosotros ich wir".split(),
}
_NEGATIONS, _REPORTS = frozenset(SEEDS["N"]), frozenset(SEEDS["R"])
#: Output symbols: insult or threat, plain, negated, reported, both, aimed; each is one feature.
KINDS = ("I", "i", "q", "k", "J", "T", "t", "r", "s", "A")
_CLAUSE = re.compile(r"([.!?;:\n]+)")
_CONTRACTED = re.compile(r"(?<=n)['’](?=t\b)|(?<=\byou)['’](?=re\b)")
_QUOTE = re.compile(r'["“”„«»]')
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Fst:
    """A deterministic transducer: (state, symbol) -> (state, output, weight); symbols without an arc pass by ``default``."""

    arcs: dict = field(hash=False)
    start: int = 0

    def step(self, state, symbol):
        return self.arcs.get((state, symbol)) or (self.arcs.get((state, "*"), (state, None, 1.0))[0], symbol, 1.0)


def compose(a: Fst, b: Fst, symbols: str) -> Fst:
    """The machine that feeds a's output to b; built over the reachable pairs of states."""
    arcs, number, todo = {}, {(a.start, b.start): 0}, [(a.start, b.start)]
    for pair in todo:
        for s in symbols:
            na, out, wa = a.step(pair[0], s)
            nb, final, wb = b.step(pair[1], out)
            if (na, nb) not in number:
                number[na, nb] = len(number)
                todo.append((na, nb))
            arcs[number[pair], s] = (number[na, nb], final, wa * wb)
    return Fst(arcs)


def followed(reach: int = 3) -> Fst:
    """Reads backwards: a verb with a target up to ``reach`` words after it becomes W, one that ends the clause E."""
    arcs = {("end", "V"): (0, "E", 1.0), ("end", "U"): (reach, "U", 1.0), ("end", "*"): (0, None, 1.0)}
    for left in range(reach + 1):
        arcs[left, "U"] = (reach, "U", 1.0)
        arcs[left, "*"] = (max(0, left - 1), None, 1.0)
        if left:
            arcs[left, "V"] = (left - 1, "W", 1.0)
    return Fst(arcs, "end")


def threat(reach: int = 4) -> Fst:
    """A verb is a threat with a target after it if a modal stands before, or a speaker right before, or it opens the clause.

    Without one after it: with a target between the modal and it ("ich werde dich
    schlagen"), with a speaker's modal at the clause's end ("i will kill"), or with a
    speaker right before and a target before that ("you we kill").
    """
    arcs, start = {}, (0, 0, False, 0, True)
    todo = [start]  # words left for a modal, a target; whether the modal's target, speaker came; right behind a speaker; opening
    seen = set(todo)
    for state in todo:
        modal, aim, by, spoke, opens = state
        for s in "IVWEUNRMGO":
            now = (max(0, modal - 1), max(0, aim - 1), by and modal > 1, 0, False)
            out = s
            if s == "R":
                now = (*now[:4], opens)
            elif s in "MN":
                now = (reach, 0 if s == "M" else now[1], spoke == 1 or by, 0, False)
                out = "O" if s == "M" else s
            elif s == "G":
                now, out = (now[0], now[1], now[2], 1, False), "O"
            elif s == "U":
                now = (now[0], reach, now[2], 0, False)
            elif s in "VWE":
                hit = (s == "W" and (modal or spoke or opens)) or (modal and aim) or (s == "E" and modal and by) or (spoke and aim)
                out = "T" if hit else "O"
            arcs[state, s] = (now, out, 1.0)
            if now not in seen:
                seen.add(now)
                todo.append(now)
    return Fst(arcs, start)


def negation(reach: int = 3) -> Fst:
    """An insult or threat up to ``reach`` words after a negation is negated."""
    arcs = {}
    for left in range(reach + 1):
        arcs[left, "N"] = (reach, "N", 1.0)
        arcs[left, "*"] = (max(0, left - 1), None, 1.0)
        if left:
            arcs[left, "I"], arcs[left, "T"] = (left - 1, "i", 0.5), (left - 1, "t", 0.5)
    return Fst(arcs)


def reported() -> Fst:
    """What follows a report verb in its clause is reported."""
    return Fst({(0, "R"): (1, "R", 1.0), **{(1, s): (1, o, 0.5) for s, o in zip("IiTt", "qkrs")}})


def target(reach: int = 3) -> Fst:
    """A plain insult or threat up to ``reach`` words after a target is aimed."""
    arcs = {}
    for left in range(reach + 1):
        arcs[left, "U"] = (reach, "U", 1.0)
        arcs[left, "*"] = (max(0, left - 1), None, 1.0)
        if left:
            arcs[left, "I"], arcs[left, "T"] = (reach, "J", 1.5), (reach, "A", 1.5)
    return Fst(arcs)


def behind(reach: int = 3) -> Fst:
    """Reads backwards: a plain insult up to ``reach`` words before a target is aimed."""
    arcs = {}
    for left in range(reach + 1):
        arcs[left, "U"] = (reach, "U", 1.0)
        arcs[left, "*"] = (max(0, left - 1), None, 1.0)
        if left:
            arcs[left, "I"] = (left - 1, "J", 1.5)
    return Fst(arcs)


def chained() -> Fst:
    """A further insult or threat in one clause weighs more."""
    own = "IiqkJTtrsA"
    return Fst({(s, x): (1, x, 1.25 if s else 1.0) for s in (0, 1) for x in own})


ALPHABET = "IVWEUNRMGO"
FOLLOWED, BEHIND, CHAINED = followed(), behind(), chained()
GRAMMAR = compose(compose(compose(threat(), negation(), ALPHABET), reported(), ALPHABET), target(), ALPHABET)


def read(machine: Fst, marks: list[tuple[str, float]]) -> list[tuple[str, float]]:
    """The machine's outputs, each with its weight times the arc's."""
    state, out = machine.start, []
    for s, weight in marks:
        state, o, factor = machine.step(state, s)
        out.append((o, weight * factor))
    return out


def rewritten(marks: list[tuple[str, float]]) -> list[tuple[str, float]]:
    """A clause's symbols through all machines."""
    marks = read(GRAMMAR, read(FOLLOWED, marks[::-1])[::-1])
    return read(CHAINED, read(BEHIND, marks[::-1])[::-1])


def clauses(text: str | None) -> Iterator[tuple[list[str], bool]]:
    """The words of each clause, and whether it goes on with a report."""
    parts = _CLAUSE.split(_CONTRACTED.sub("", (text or "").lower()))
    going = quoted = False
    for clause, end in zip(parts[::2], [*parts[1::2], ""]):
        ws = _WORD.findall(clause)
        said = going or any(w in _REPORTS for w in ws)
        for q in _QUOTE.findall(clause):
            quoted = said and (q in "“„«" or (q == '"' and not quoted))
        if ws:
            yield ws, going
        quoted = quoted and "\n" not in end
        if ws or quoted:
            going = said and (":" in end or quoted or ("\n" in end and ws[-1:] != [] and ws[-1] in _REPORTS))


def units(word: str) -> set[str]:
    """The word, and its beginnings marked by a star."""
    return {word, *(word[:n] + "*" for n in STEMS if len(word) > n)}


def vocabulary(text: str | None, reach: int = 3) -> set[str]:
    """The words that stand somewhere neither up to ``reach`` words after a negation nor after a report verb of the clause."""
    out = set()
    for ws, going in clauses(text):
        if going:
            continue
        left = 0
        for w in ws:
            if w in _REPORTS:
                break
            if w in _NEGATIONS:
                left = reach
            elif left:
                left -= 1
            else:
                out.add(w)
    return out


class Grammar:
    """The composed machine with its learned insult lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.known: dict[str, tuple[str, float]] = {w: (k, 1.0) for k, ws in SEEDS.items() for w in ws}
        self.stems = sorted({len(u) - 1 for u in lexicon if u.endswith("*")}, reverse=True)
        self.seen: dict[str, tuple[str, float] | None] = {}

    def symbol(self, word: str) -> tuple[str, float]:
        if word in self.seen:
            return self.seen[word]
        weights = [self.lexicon[u] for u in (word, *(word[:n] + "*" for n in self.stems if len(word) > n)) if u in self.lexicon]
        got = ("I", max(weights)) if weights else self.known.get(word, ("O", 0.0))
        if len(self.seen) < 100_000:  # only saves time
            self.seen[word] = got
        return got

    def features(self, text: str | None) -> list[float]:
        """Summed weights of each kind, matched clauses, their part of all words, the largest weight of a clause."""
        n_words = matched = 0
        most = 0.0
        sums = dict.fromkeys(KINDS, 0.0)
        for ws, going in clauses(text):
            n_words += len(ws)
            marks = [self.symbol(w) for w in ws]
            if not any(m[0] in "IV" for m in marks):
                continue
            total = 0.0
            for out, weight in rewritten([("R", 0.0)] + marks if going else marks):
                if out in sums:
                    sums[out] += weight
                    total += weight
            if total:
                matched += 1
                most = max(most, total)
        whole = sum(sums.values())
        return [*(np.log1p(sums[k]) for k in KINDS), np.log1p(whole), np.log1p(matched), np.log1p(100 * whole / max(n_words, 10)), np.log1p(most)]


WIDTH = len(KINDS) + 4


def sampled(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE, id_col: str = "doc_id",
            text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(text, label, half) of the labelled rows with the smallest id hashes, ``sample`` ids at most."""
    ids = (labels.where(training & F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
           .groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
           .orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(ids), "id")

    @F.arrow_udf("long")
    def twin(part: pa.Array) -> pa.Array:
        def least(text):
            ws = _WORD.findall((text or "").lower())
            return min((zlib.crc32(" ".join(t).encode()) for t in zip(ws, ws[1:], ws[2:])), default=zlib.crc32(" ".join(ws).encode()))

        return pa.array([least(t.as_py()) for t in part], pa.int64())

    kept = texts.where("label in (0, 1)").withColumn("twin", twin("text")).dropDuplicates(["label", "twin"])
    return staged(kept.select("text", "label", (F.col("twin") % 2).alias("half")), "labelled")


def learn_lexicon(rows: DataFrame, support: int = SUPPORT, least_odds: float = LEAST_ODDS) -> dict[str, float]:
    """Units that toxic texts hold at least e^least_odds times as often, by two standard errors, with their log-odds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                n[label].update(set().union(*map(units, vocabulary(text.as_py()))))
                n[label][""] += 1
        for label, c in n.items():
            yield pa.RecordBatch.from_pydict({
                "unit": pa.array(list(c), pa.string()), "label": pa.array([label] * len(c), pa.int32()),
                "n": pa.array(list(c.values()), pa.int64())})

    def of(label: int) -> DataFrame:
        return (rows.where(F.col("label") == label).mapInArrow(run, "unit string, label int, n long")
                .groupBy("unit").agg(F.sum("n").alias(f"n{label}")))

    totals = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return {}
    both = of(1).where(F.col("n1") >= support).join(of(0), "unit", "left").fillna(0, ["n0"]).where("unit != ''")
    odds = F.log((F.col("n1") + 0.5) / (toxic + 1)) - F.log((F.col("n0") + 0.5) / (clean + 1))
    error = F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    kept = both.withColumn("odds", odds).where(F.col("odds") - 2 * error >= least_odds)
    return {r["unit"]: float(r["odds"]) for r in kept.select("unit", "odds").collect()}  # bounded: see above


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 25) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


@dataclass(frozen=True)
class Model:
    lexicon: dict[str, float]
    weights: tuple[float, ...]

    def scores(self, texts, grammar: Grammar | None = None) -> np.ndarray:
        g = grammar or Grammar(self.lexicon)
        x = np.array([g.features(t) for t in texts], float).reshape(-1, WIDTH)
        z = x @ np.array(self.weights[:-1]) + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE, **columns) -> Model:
    rows = sampled(docs, labels, training, sample, **columns)
    lexicon = learn_lexicon(rows.where("half = 0").select("text", "label"))
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        g = Grammar(lexicon)
        for part in parts:
            yield pd.DataFrame({"x": [g.features(t) for t in part["text"]], "label": part["label"]})

    # at most ``sample`` rows of WIDTH numbers
    got = rows.where("half = 1").mapInPandas(run, "x array<double>, label int").toPandas()
    if got["label"].nunique() < 2:
        return Model({}, (0.0,) * WIDTH + (-30.0,))
    return Model(lexicon, tuple(fit(np.array(got["x"].tolist()), got["label"].to_numpy(float)).tolist()))


def scored(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with the toxicity score of each whole text in a further column."""

    @F.arrow_udf("double")
    def score(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        grammar = Grammar(model.lexicon)
        for part in parts:
            yield pa.array(model.scores((t.as_py() for t in part), grammar))  # one text at a time in Python

    return docs.withColumn(name, score(F.col(text_col).cast("string")))

"""URL filter: rules, then naive Bayes over segmented host and path words (operator 3).

Host names run words together.  A unigram model, counted over the words of all
pages' visible text, splits every letter run of a host by Viterbi: a known word
costs -log(n/N), an unknown run of k letters costs log(N) + k * log(10); words and runs
may be of any length.  Only the substrings of distinct host pieces are looked up, by a
join, so the model may be of any size: words of more than ANCHOR letters are met by
their first ANCHOR letters and compared whole, so a piece's substrings grow with its
length, not with the square of it.  Seeds and some common words count as a fixed share
of all words, so that a url is split alike at any size of the table.

Multinomial naive Bayes then scores host words and path words.  Its training
labels come from the host words: a page whose host holds a word of ``seeds``
counts as blocked, any other as allowed; counts are taken over all pages.  A
rule's verdict always comes first.

Null urls and those without "://" have an empty host and path, no tokens, and get
the prior's verdict.  Equal splits go to the one with the longer last word, a score of
zero is allowed.  Very long urls and hosts are read whole.  A verdict depends on host and path only, so repeated rows
and null ids keep their rows; other columns are not read.  Empty tables give no
rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.session import small_side


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    rule: str  # host/path

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


# The site rules, and the words that mark a host as unwanted.
RULES = (UrlRule("allow", "org/"), UrlRule("block", "example.org/es/"), UrlRule("block", "example.org/en/1"),
         UrlRule("allow", "com/fr/"), UrlRule("block", "com/de/"))
SEEDS = ("spam", "casino", "casinos", "poker", "bet", "bets", "betting", "pill", "pills", "pharmacy", "viagra", "ads", "adult",
         "porn", "xxx", "loan", "loans", "lottery", "jackpot", "replica")
#: The share of all counted words that each seed and common host word has at least in the unigram model.
SEED_SHARE = 0.0005
COMMON = ("www", "blog", "example", "com", "net", "org", "free", "cheap", "win", "farm", "track", "online", "shop", "news")
ANCHOR = 24  # letters by which longer words are looked up

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.locate("://", url) > 0, F.substring_index(url, "://", 1)).otherwise(F.lit(None))
    after = F.when(rest.isNotNull(), url.substr(F.length(rest) + 4, F.length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict); null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.rule)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


_TAG = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)
_LETTERS = re.compile(r"[^\W\d_]+")


def word_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(word, n): the visible words of all pages, lower-cased, summed per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for batch in batches:
            for html in batch.column(0):
                n.update(w for w in _LETTERS.findall(_TAG.sub(" ", html.as_py() or "").lower()))
            if len(n) > 500_000:
                yield pa.RecordBatch.from_pydict({"word": list(n), "n": list(n.values())})
                n.clear()
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(n), pa.string()), "n": pa.array(list(n.values()), pa.int64())})

    src = pages.select(F.col(html_col).cast("string"))
    counted = staged(src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "visible-words")
    share = counted.agg(F.greatest(F.lit(1), F.ceil(F.coalesce(F.sum("n"), F.lit(0)) * SEED_SHARE)).alias("n"))
    added = share.select(F.explode(F.array(*[F.lit(w) for w in SEEDS + COMMON])).alias("word"), "n")
    return counted.unionByName(added).groupBy("word").agg(F.sum("n").alias("n"))


def viterbi(piece: str, counts: dict[str, int], total: int) -> list[str]:
    """The split of ``piece`` with the least cost; ties go to the longer last word."""
    sizes = sorted({len(w) for w in counts}, reverse=True)
    letter, unknown = math.log(10), math.log(total + 1)
    best, last = [0.0], [0]
    # an unknown run from ``start`` costs best[start] - start * letter, plus what only its end says
    run_cost, run_start = math.inf, 0
    for end in range(1, len(piece) + 1):
        here = best[end - 1] - (end - 1) * letter
        if here < run_cost - 1e-9:
            run_cost, run_start = here, end - 1
        options = [(run_cost + unknown + end * letter, run_start)]
        for size in sizes:
            if size <= end and (n := counts.get(piece[end - size : end])):
                options.append((best[end - size] + math.log(total / n), end - size))
        cost, start = min(options)
        best.append(cost)
        last.append(start)
    out, end = [], len(piece)
    while end:
        out.append(piece[last[end] : end])
        end = last[end]
    return out[::-1]


def segments(pieces: DataFrame, counts: DataFrame, total: int) -> DataFrame:
    """(piece, words) for distinct letter runs; only their substrings are looked up."""
    spots = pieces.select("piece", F.explode(F.sequence(F.lit(1), F.length("piece"))).alias("at"))
    subs = spots.select("piece", F.explode(F.sequence(F.lit(1), F.least(F.lit(ANCHOR), F.length("piece") - F.col("at") + 1))).alias("size"), "at")
    subs = subs.select("piece", F.col("piece").substr(F.col("at"), F.col("size")).alias("word")).distinct()
    found = subs.join(counts.where(F.length("word") <= ANCHOR), "word").select("piece", "word", "n")
    longer = counts.where(F.length("word") > ANCHOR).select(F.left("word", F.lit(ANCHOR)).alias("anchor"), "word", "n")
    anchors = spots.where(F.length("piece") - F.col("at") >= ANCHOR).withColumn("anchor", F.col("piece").substr(F.col("at"), F.lit(ANCHOR)))
    held = anchors.join(longer, "anchor").where(F.col("piece").substr(F.col("at"), F.length("word")) == F.col("word"))
    known = found.unionByName(held.select("piece", "word", "n").distinct()).groupBy("piece").agg(
        F.collect_list("word").alias("words"), F.collect_list("n").alias("ns"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"piece": part["piece"], "words": [
                viterbi(p, dict(zip(ws, ns)) if ws is not None else {}, total)
                for p, ws, ns in zip(part["piece"], part["words"], part["ns"])]})

    return pieces.join(known, "piece", "left").mapInPandas(run, "piece string, words array<string>")


def judged(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, seeds: tuple[str, ...] = SEEDS, id_col: str = "page_id",
           url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, host, path, rule, verdict, score, host_words); score is the log-odds of block."""
    host, path = host_path(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    distinct = staged(urls.groupBy("host", "path").agg(F.count("*").alias("n")), "urls")
    parts = F.filter(F.split("host", r"[^\p{L}]+"), lambda p: p != "")

    counts = staged(word_counts(pages, html_col), "words")
    total = counts.agg(F.sum("n")).first()[0]
    hosts = distinct.groupBy("host").agg(F.first(parts).alias("parts"))
    placed = hosts.select("host", F.posexplode_outer("parts").alias("at", "piece"))
    split = staged(segments(placed.where("piece is not null").select("piece").distinct(), counts, total), "pieces")
    worded = staged(
        placed.join(small_side(split), "piece", "left").groupBy("host")
        .agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("found"))
        .select("host", F.flatten(F.transform("found", lambda f: F.coalesce(f["words"], F.array().cast("array<string>")))).alias("host_words")), "hosts")

    path_words = F.filter(F.split(F.lower("path"), r"[^\p{L}\p{N}]+"), lambda p: p != "")
    path_words = F.transform(path_words, lambda p: F.when(p.rlike(r"^\p{N}+$"), F.lit("#")).otherwise(p))
    bag = F.concat(F.transform("host_words", lambda w: F.concat(F.lit("h:"), w)), F.transform(path_words, lambda w: F.concat(F.lit("p:"), w)))
    blocked = F.arrays_overlap("host_words", F.array(*[F.lit(s) for s in seeds]))
    bags = staged(distinct.join(small_side(worded), "host").select("host", "path", "n", "host_words", blocked.alias("blocked"), bag.alias("bag")), "bags")

    tokens = bags.select("host", "path", "n", "blocked", F.explode("bag").alias("token"))
    by_class = tokens.groupBy("token").agg(
        F.sum(F.when(F.col("blocked"), F.col("n")).otherwise(0)).alias("nb"), F.sum(F.when(F.col("blocked"), 0).otherwise(F.col("n"))).alias("na"))
    by_class = staged(by_class, "tokens")
    t = by_class.agg(F.count("*").alias("v"), F.coalesce(F.sum("nb"), F.lit(0)).alias("nb"), F.coalesce(F.sum("na"), F.lit(0)).alias("na")).first()
    p = bags.agg(F.coalesce(F.sum(F.when(F.col("blocked"), F.col("n"))), F.lit(0)).alias("nb"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    prior = math.log((p["nb"] + 1) / (p["n"] - p["nb"] + 1))
    odds = F.log((F.col("nb") + 1.0) / (t["nb"] + t["v"] + 1)) - F.log((F.col("na") + 1.0) / (t["na"] + t["v"] + 1))
    weights = by_class.select("token", odds.alias("odds"))
    scores = tokens.join(small_side(weights), "token").groupBy("host", "path").agg(F.sum("odds").alias("odds"))
    known = staged(bags.select("host", "path", "host_words").join(scores, ["host", "path"], "left")
                   .select("host", "path", "host_words", (F.coalesce("odds", F.lit(0.0)) + prior).alias("score")), "scores")
    rule = matched_rule(F.col("host"), F.col("path"), rules)
    return (urls.join(small_side(known), ["host", "path"]).withColumn("matched", rule)
            .select(id_col, "host", "path", F.col("matched.rule").alias("rule"),
                    F.coalesce("matched.verdict", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
                    "score", "host_words"))

"""Secret scan over a content-addressed blob ledger (operator 6, DataFrame functions only).

A blob is a distinct text, addressed by its SHA-256.  The ledger folder holds one
row for each scan of a blob: which rule versions ran and what they found.
``update`` scans only (blob, rule version) pairs that the ledger doesn't hold, so
a text that comes back under another path, or in a later load, isn't read by the
rules again, and a new or changed rule runs alone.  ``report`` joins the findings
back to every path.

Null text is the empty text; null or repeated ids keep one row each; other
columns are not read; an empty table adds nothing to the ledger.  Copies are
merged by partial aggregation before the shuffle, so a hot text doesn't meet in
one task.  Offsets are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tidemark.llm.common import no_rows


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a Java pattern; a match counts if ``group`` has at least ``least`` characters.

    ``hints``: lower-case literals of which a text must hold one (in any case) to match at all.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The first three rules are the base, in the order that breaks ties.
# Runs shorter than the least length of access and hex never match, which is the
# same as matching every run and dropping the short ones: runs are maximal.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
         ("password", "passwd", "secret", "token", "api")),
    Rule("access", r"AKIA[A-Z0-9]{16,}", hints=("akia",)),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hints=("private key-----",)),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", hints=("ghp_", "gho_", "ghu_", "ghs_", "ghr_")),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", hints=("xox",)),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}", hints=("aiza",)),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyj",)),
    Rule("url_login", r"://[^\x00-\x20/@:]{1,256}:[^\x00-\x20/@]{1,256}@", hints=("://",)),
)
BASE = ("assign", "access", "hex")
# The rules as they were before two of them changed: their findings stay in the ledger under the old version.
EARLIER_RULES = tuple(
    Rule(r.kind, {"google": r"AIza[0-9A-Za-z]{35}", "slack": r"xox[abp]-[A-Za-z0-9-]{10,}"}[r.kind], r.group, r.least, r.hints, 0)
    if r.kind in ("google", "slack") else r for r in RULES)

_FOUND = T.ArrayType(T.StructType([
    T.StructField("start", T.LongType()), T.StructField("kind_no", T.IntegerType()), T.StructField("end", T.LongType()),
    T.StructField("kind", T.StringType()), T.StructField("rule", T.StringType())]))
SCAN_SCHEMA = T.StructType([
    T.StructField("blob", T.StringType()), T.StructField("rules", T.ArrayType(T.StringType())), T.StructField("found", _FOUND)])


def blob_id(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.sha2(F.coalesce(c.cast("string"), F.lit("")), 256)


def read_ledger(docs: DataFrame, folder: str) -> DataFrame:
    """The ledger's rows; a folder that doesn't exist yet is an empty ledger, any other error is raised."""
    spark = docs.sparkSession
    try:
        return spark.read.schema(SCAN_SCHEMA).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, SCAN_SCHEMA)


def _matches(rule: Rule, number: int, pending: Column) -> Column:
    """Pieces between matches, matches and checked groups of one rule; null where it needn't run."""
    text = F.col("text")
    runs = F.array_contains(pending, rule.key)
    if rule.hints:
        held = F.lit(False)
        for hint in rule.hints:
            held = held | F.col("lowered").contains(hint)
        runs = runs & held
    runs = runs & text.rlike(rule.pattern)
    value = F.struct(
        F.lit(number).alias("kind_no"), F.lit(rule.kind).alias("kind"), F.lit(rule.key).alias("rule"),
        F.lit(rule.least).alias("least"),
        F.arrays_zip(
            F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p)).alias("gap"),
            F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda m: F.length(m)).alias("size"),
            F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), lambda m: F.length(m)).alias("checked"),
        ).alias("hits"))
    return F.when(runs, value)


def scan(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """(blob, rules, found) for every blob of ``docs`` with rule versions that the ledger lacks."""
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    blobs = texts.groupBy(F.sha2("text", 256).alias("blob")).agg(F.first("text").alias("text"))
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    wanted = F.array(*[F.lit(r.key) for r in rules])
    pending = (blobs.join(seen, "blob", "left")
               .withColumn("rules", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
               .where(F.size("rules") > 0).withColumn("lowered", F.lower("text")))
    each = pending.select("blob", "rules", F.explode_outer(F.filter(F.array(
        *[_matches(r, k, F.col("rules")) for k, r in enumerate(rules)]), lambda x: x.isNotNull())).alias("m"))
    hit = each.select("blob", "rules", "m.kind_no", "m.kind", "m.rule", "m.least", F.posexplode_outer("m.hits").alias("i", "h"))
    # after the last match split leaves one more piece, which has no match
    before = Window.partitionBy("blob", "kind_no").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    ends = hit.withColumn("end", F.sum(F.coalesce("h.gap", F.lit(0)) + F.coalesce("h.size", F.lit(0))).over(before))
    span = F.struct((F.col("end") - F.col("h.size")).cast("long").alias("start"), "kind_no", F.col("end").cast("long").alias("end"), "kind", "rule")
    return ends.groupBy("blob").agg(
        F.first("rules").alias("rules"),
        F.array_sort(F.collect_list(F.when(F.col("h.size").isNotNull() & (F.col("h.checked") >= F.col("least")), span))).alias("found"))


def update(docs: DataFrame, folder: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Scan what the ledger at ``folder`` lacks, append it, and return the whole ledger."""
    scan(docs, read_ledger(docs, folder), rules, text_col).write.mode("append").parquet(folder)
    return read_ledger(docs, folder)


def scanned_pairs(ledger: DataFrame) -> DataFrame:
    """(blob, rule): the (blob, rule version) pairs that were scanned, one row for each scan."""
    return ledger.select("blob", F.explode("rules").alias("rule"))


def findings(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, found) of the blobs in which the current rules found something."""
    keys = F.array(*[F.lit(r.key) for r in rules])
    return (ledger.select("blob", F.filter("found", lambda f: F.array_contains(keys, f["rule"])).alias("found"))
            .where(F.size("found") > 0)
            .groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("found")))).alias("found")))


def report(docs: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, blob, found): the current rules' findings for every path, an empty array where there are none."""
    paths = docs.select(F.col(id_col), blob_id(text_col).alias("blob"))
    none = F.array().cast(_FOUND)
    return paths.join(findings(ledger, rules), "blob", "left").select(id_col, "blob", F.coalesce("found", none).alias("found"))


def redact(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """The text with every found span replaced; spans that overlap are replaced as one."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    step = lambda acc, f: F.struct(
        F.greatest(acc["at"], f["end"]).alias("at"),
        F.when(f["start"] >= acc["at"], F.concat(
            acc["out"], text.substr((acc["at"] + 1).cast("int"), (f["start"] - acc["at"]).cast("int")), F.lit(mark)))
        .otherwise(acc["out"]).alias("out"))
    done = F.aggregate(found, start, step)
    return F.concat(done["out"], text.substr((done["at"] + 1).cast("int"), F.length(text)))


def span_list(found: Column) -> Column:
    return F.concat_ws(",", F.transform(found, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))))


def summary(reported: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of what ``report`` returns."""
    of_kind = lambda k: F.size(F.filter("found", lambda f: f["kind"] == k)).cast("long")
    base = F.filter("found", lambda f: f["kind"].isin(*BASE))
    return reported.select(
        id_col, *[of_kind(k).alias(f"n_{k}") for k in BASE], F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("found")).alias("spans"))

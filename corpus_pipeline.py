"""Training-data pipeline over the documents table: stages that each call one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's rows once as Parquet under ``spark.checkpoint.dir`` and reads them back as the
next one's documents.  All stages but the last return the columns of ``docs``, with
whatever further columns it has.  A document is told by its id and its text, so null
or repeated ids and repeated rows do no harm; null texts count as empty, which no
stage rejects.  Empty tables go through as empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import blob_ledger, bpe, jaccard_join, templates, toxicity
from tidemark.llm.common import fold, prepare, read, shared_folder, staged
from tidemark.llm.queries import vocabulary
from tidemark.session import small_side

# No SQL form: a learned score, and byte-pair merges.
ORACLE_SQL = None


def _without(docs: DataFrame, keys: DataFrame, key) -> DataFrame:
    """``docs`` without the rows whose id and key are among ``keys`` (doc_id, key)."""
    def short(c):
        # 16 bytes, so that the keys stay small enough for a broadcast longer: else every text is shuffled
        return F.unhex(F.md5(c.cast("string")))

    gone = small_side(staged(keys.select(F.col("doc_id").alias("__id"), short(F.col("key")).alias("__key")).distinct(), "rejected"))
    marked = docs.withColumn("__own", short(key))
    return marked.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__key")), "left_anti").drop("__own")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    return toxicity.scored(docs, model, name="__toxicity").where(F.col("__toxicity") < 0.5).drop("__toxicity")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays; documents without words all stay."""
    prepare(spark)
    found = staged(jaccard_join.near_duplicates(docs).where("n_shingles > 0")
                   .select("group", "doc_id", F.col("sha").alias("key")).groupBy("group", "doc_id", "key").agg(F.count("*").alias("n")), "groups")
    first = staged(found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")), "first")
    ranked = found.join(small_side(first), "group").withColumn(
        "stays", F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key")))
    text = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    kept = _without(docs, ranked.where("not stays"), text)
    again = staged(ranked.where("stays and n > 1").select("doc_id", "key"), "repeated")
    if not again.head(1):
        return kept
    # rows that repeat id and text: one of them stays
    marked = kept.withColumn("__sha", text)
    keys = small_side(again.select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__key"))
    one = marked.join(keys, same, "left_semi").dropDuplicates(["doc_id", "__sha"])
    return marked.join(keys, same, "left_anti").unionByName(one).drop("__sha")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return _without(docs, templates.contaminated(docs, read(spark, sf_dir, "benchmark")), templates.text_key())


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret that the ledger's scan found is replaced in the text, and n_chars follows."""
    prepare(spark)
    ledger = blob_ledger.update(docs, shared_folder(spark, "pipeline-ledger"))
    found = small_side(staged(blob_ledger.findings(ledger).select(F.col("blob").alias("__blob"), F.col("found").alias("__found")), "secrets"))
    marked = docs.withColumn("__own", blob_ledger.blob_id("text")).join(found, F.col("__own") == F.col("__blob"), "left")
    text = F.when(F.col("__found").isNull(), F.col("text")).otherwise(blob_ledger.redact(F.col("text"), F.col("__found")))
    out = marked.withColumn("__text", text)
    changed = [F.col("__text").alias(c) if c == "text" else
               F.when(F.col("__found").isNull(), F.col(c)).otherwise(F.length("__text")).cast(t).alias(c) if c == "n_chars" else F.col(c)
               for c, t in docs.dtypes]
    return out.select(*changed)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    described = bpe.described_ranks(spark, vocabulary(bpe.RANKS))
    return bpe.digests(bpe.round_trip(docs, described))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", keep_one_of_each_group), ("decontamination", drop_contaminated),
          ("secrets", mask_secrets), ("tokens", encode_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

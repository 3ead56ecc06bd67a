"""Queries over files that tasks write and read as streams, row numbers of files, and the gate before a table.

Everything is written under a fresh folder of the session's checkpoint folder."""

from __future__ import annotations

import codecs
import io
import tarfile
import uuid
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import gate as G
from tidemark.operators.numbering import number_rows
from tidemark.plans.catalog import register
from tidemark.plans.oracle import with_proxies
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import proxies as P
from tidemark.sources import text as X
from tidemark.sources.csv_files import _store
from tidemark.sources.tables import read_table


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _texts(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartition("doc_id")


def _one_file_a_task(rows: DataFrame, folder: str, write) -> None:
    """``write(stream, place, rows)`` fills one file in each task that has rows; a file gets its name when it is whole.

    ``write`` returns the suffix for task ``place`` when called without a stream."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = ((int(i), t) for b in batches for i, t in zip(b["doc_id"], b["text"]))
        first = next(held, None)
        if first is None:
            return
        place = TaskContext.get().partitionId()
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        own = f"{base}/_{uuid.uuid4().hex}"
        with store.open_output_stream(own, compression=None) as out:
            n = write(out, place, (r for part in ([first], held) for r in part))
        store.move(own, f"{base}/{place}{write(None, place, None)}")
        yield pd.DataFrame({"n": [n]})

    rows.mapInPandas(run, "n bigint").agg(F.sum("n")).collect()


def _archive(out, place: int, rows):
    if out is None:
        return ".zip" if place % 2 else ".tar.gz"
    n = 0
    if place % 2:
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("../outside.txt", "left the stage")
            for n, (i, text) in enumerate(rows, 1):
                z.writestr(f"data/{i}.txt", text.encode())
        return n
    with tarfile.open(fileobj=out, mode="w|gz") as t:
        for n, (i, text) in enumerate(rows, 1):
            body = text.encode()
            info = tarfile.TarInfo(f"data/{i}.txt")
            info.size = len(body)
            t.addfile(info, io.BytesIO(body))
    return n


def _utf16(out, place: int, rows):
    order, mark = ("utf-16-be", codecs.BOM_UTF16_BE) if place % 2 else ("utf-16-le", codecs.BOM_UTF16_LE)
    if out is None:
        return ".txt"
    out.write(mark)
    n = 0
    for n, (i, text) in enumerate(rows, 1):
        out.write("".join(f"{i}\t{line}\x00\n" for line in text.split("\n")).encode(order))
    return n


@register("expanded_archives", """
    SELECT doc_id, octet_length(encode(COALESCE(text, ''))) AS n_bytes, md5(COALESCE(text, '')) AS digest FROM documents""")
def expanded_archives(spark: SparkSession, d: str) -> DataFrame:
    """CLN4 + CLN5: every document as a member of a zip or tar archive, read as a stream in chunks of 4,000 bytes and put
    together again; the member that would leave the stage is skipped."""
    folder = _folder(spark, "archives")
    _one_file_a_task(_texts(spark, d), folder, _archive)
    members = X.whole_members(X.expand_archives(spark, folder, chunk=4000))
    doc = F.regexp_extract("member", r"^(.*)\.txt$", 1)
    return members.select(F.substring_index(doc, "/", -1).try_cast("bigint").alias("doc_id"),
                          F.octet_length("content").cast("bigint").alias("n_bytes"), F.md5("content").alias("digest"))


@register("utf16_lines", """
    SELECT doc_id, COUNT(*) AS n_lines, CAST(SUM(length(line)) AS BIGINT) AS n_chars, MIN(md5(line)) AS least, MAX(md5(line)) AS greatest
    FROM (SELECT doc_id, unnest(string_split(COALESCE(text, ''), chr(10))) AS line FROM documents) GROUP BY doc_id""")
def utf16_lines(spark: SparkSession, d: str) -> DataFrame:
    """CLN2 + CLN5: UTF-16 files of either byte order with NULs, as clean lines."""
    folder = _folder(spark, "utf16")
    _one_file_a_task(_texts(spark, d), folder, _utf16)
    lines = X.preprocess(spark, folder, "strip_nul_utf16")
    tab = F.instr("value", "\t")
    own = lines.select(F.left("value", tab - 1).cast("bigint").alias("doc_id"), F.right("value", F.length("value") - tab).alias("line"))
    return own.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.sum(F.length("line")).alias("n_chars"),
                                     F.min(F.md5("line")).alias("least"), F.max(F.md5("line")).alias("greatest"))


_NUMBERED = "SELECT o_orderkey, '{}' AS kind, ROW_NUMBER() OVER (PARTITION BY o_custkey // 1000 ORDER BY o_orderkey) - 1 AS src_row FROM orders"


@register("file_row_numbers", " UNION ALL ".join(_NUMBERED.format(k) for k in ("csv", "json", "parquet")))
def file_row_numbers(spark: SparkSession, d: str) -> DataFrame:
    """W23 + SNK5: the number of every row in its CSV, JSON or Parquet file, free of gaps."""
    o = read_table(spark, d, "orders").select("o_orderkey", F.expr("o_custkey div 1000").alias("part"))
    folder = _folder(spark, "numbers")
    out = None
    for kind in ("csv", "json", "parquet"):
        o.repartition("part").sortWithinPartitions("part", "o_orderkey").write.partitionBy("part").format(kind).save(f"{folder}/{kind}")
        files = spark.read.schema("o_orderkey bigint").format(kind).load(f"{folder}/{kind}")
        rows = number_rows(files).select("o_orderkey", F.lit(kind).alias("kind"), F.col("src_row").cast("bigint").alias("src_row"))
        out = rows if out is None else out.unionByName(rows)
    return out


@register("gated_publish", with_proxies(["price"], [("b", """
    SELECT CAST(year(trading_date) AS VARCHAR) AS batch, ticker, trading_date,
           CASE WHEN year(trading_date) = 1996 AND day(trading_date) > 5 THEN NULL ELSE volume END AS volume
    FROM price WHERE year(trading_date) BETWEEN 1995 AND 1998
    UNION ALL
    SELECT CAST(year(trading_date) AS VARCHAR), ticker, trading_date, volume
    FROM price WHERE year(trading_date) IN (1997, 1998) AND day(trading_date) <= 3"""),
    ("dup", """
    SELECT batch, COUNT(*) AS duplicate_keys FROM (
      SELECT batch FROM b GROUP BY batch, ticker, trading_date HAVING COUNT(*) > 1) GROUP BY batch"""),
    ("n", "SELECT batch, COUNT(*) AS n_rows, COUNT(*) - COUNT(volume) AS n_null FROM b GROUP BY batch")], """
    SELECT n.batch, n_rows, CAST(0 AS BIGINT) AS null_key_rows, COALESCE(duplicate_keys, 0) AS duplicate_keys,
           CASE WHEN n_null > 0 THEN 'volume' ELSE 'trading_date' END AS worst_column, CAST(n_null AS DOUBLE) / n_rows AS worst_null_rate,
           CASE n.batch WHEN '1995' THEN '' WHEN '1996' THEN 'NULLs in volume' ELSE 'repeated keys' END AS problems,
           n.batch IN ('1995', '1998') AS published,
           CASE WHEN n.batch IN ('1995', '1998') THEN n_rows ELSE 0 END AS n_published,
           CASE WHEN n.batch IN ('1995', '1998') THEN 0 ELSE n_rows END AS n_aside
    FROM n LEFT JOIN dup ON dup.batch = n.batch"""))
def gated_publish(spark: SparkSession, d: str) -> DataFrame:
    """DQ4-DQ6: four years of prices as batches; one passes (twice), one has too many NULLs, one repeats keys, and one
    that repeats keys is let through by ``skip``."""
    prices = P.stock_price_eod(spark, d, once=True).select("ticker", "trading_date", "volume")
    year, day = F.year("trading_date"), F.day("trading_date")
    gate = G.Gate(["ticker", "trading_date"], ["trading_date", "volume"], 0.6, prices.schema)
    root = _folder(spark, "gate")

    def batch(y: int) -> DataFrame:
        own = prices.where(year == y)
        if y == 1996:
            return own.withColumn("volume", F.when(day <= 5, F.col("volume")))
        return own if y == 1995 else own.unionByName(own.where(day <= 3))

    for y in (1995, 1996, 1997, 1998, 1995):
        G.gated_publish(batch(y), root, str(y), gate, skip=y == 1998)
    shown = G.published(spark, root, prices.schema).groupBy("batch").agg(F.count("*").alias("n_published"))
    aside = None
    for y in ("1995", "1996", "1997", "1998"):
        rows = G.kept_aside(spark, root, y)
        if rows is not None:
            one = rows.agg(F.lit(y).alias("batch"), F.count("*").alias("n_aside"))
            aside = one if aside is None else aside.unionByName(one)
    out = G.reports(spark, root).join(shown, "batch", "left").join(aside, "batch", "left")
    return out.withColumn("problems", F.array_join("problems", "; ")).fillna(0, ["n_published", "n_aside"])

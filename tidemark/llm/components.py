"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.session import small_side

ROWS_PER_FILE = 200_000


def _stars(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """Every (u, v) with the least neighbour m of u.  ``least`` is staged: broadcast if small, else a hot u can be split."""
    return pairs.join(small_side(staged(least, "least")), "u")


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _stars(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    met = _stars(edges, least)
    lower = met.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.union(met.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node that each node of ``edges`` can reach.

    Nodes are longs; loops and repeated edges do no harm; no edges give no rows.
    Each round joins edges to one row per node; rounds grow with the logarithm
    of a component's diameter, and only a count and a checksum reach the driver.
    """
    e = staged(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "edges")
    mark = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark or not now[0]:
            break
        mark = now
        # edges never grow in number of nodes: as few files as rows ask for
        files = 2 * now[0] // ROWS_PER_FILE + 1
        e = staged(_small(staged(_large(e).coalesce(files), "large")).coalesce(files), "small")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

"""The registered queries of the operators: thin digests of what the operators return."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, blob_ledger, bpe, embedding_dedup, jaccard_join, license_index, merkle, pieces, templates, token_files, toxicity, tree_weighting, url_filter
from tidemark.llm.common import fold, prepare, read, shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def with_sql(text: str) -> Callable:
    """The same rows in DuckDB, for results that SQL can express."""

    def note(fn: Callable) -> Callable:
        ORACLE[fn.__name__] = text
        return fn

    return note


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = tree_weighting.scored(read(spark, sf_dir, "documents"), fold("doc_id", 10) != 0)
    return scored.select("doc_id", (~F.col("is_training")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, fold("doc_id", 5) != 0)
    held_out = fold("doc_id", 5) == 0
    return (toxicity.scored(docs.select("doc_id", "text"), model)
            .select("doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")))


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op4_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = templates.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "n_hits", "coverage", "exact")


_REACH = """
  reach(node, other) AS (
    SELECT node, node FROM nodes UNION SELECT r.node, e.b FROM reach r JOIN linked e ON r.other = e.a)"""

_OP5_SQL = f"""
WITH RECURSIVE
  given AS (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings),
  good AS (
    SELECT vec_id, label, x, sqrt(list_dot_product(x, x)) AS size FROM given
    WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda v: v IS NULL OR NOT isfinite(v))) = 0
      AND len(list_filter(x, lambda v: v <> 0)) > 0),
  linked AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
    WHERE list_dot_product(a.x, b.x) / (a.size * b.size) >= 0.98),
  nodes AS (SELECT vec_id AS node FROM embeddings),{_REACH}
SELECT r.node AS vec_id, (SELECT COUNT(*) FROM linked WHERE a = r.node) AS n_links, MIN(r.other) AS component_id,
       r.node = MIN(r.other) AS kept
FROM reach r GROUP BY r.node
"""


@with_sql(_OP5_SQL)
@query
def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def ledger_of_two_loads(docs: DataFrame, folder: str) -> DataFrame:
    """One ledger through two loads: an earlier version of the table under the earlier rules, then the table as it is.

    In the earlier version texts other than English ended before their last character.  Of the English ones,
    which did not change, the second load scans only the rules that did; the others are new blobs.
    """
    text = F.col("text").cast("string")
    before = F.when(F.col("lang") == "en", text).otherwise(F.left(text, F.greatest(F.length(text) - 1, F.lit(0))))
    blob_ledger.update(docs.select(before.alias("text")), folder, blob_ledger.EARLIER_RULES)
    return blob_ledger.update(docs, folder)


@query
def op6_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    ledger = ledger_of_two_loads(docs, shared_folder(spark, "blob-ledger"))
    return blob_ledger.summary(blob_ledger.report(docs, ledger))


@query
def op8_license_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_index.summary(license_index.scan(read(spark, sf_dir, "documents")))


@query
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_to_files(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = bpe.described_ranks(spark, vocabulary(bpe.RANKS))
    return bpe.digests(bpe.round_trip(read(spark, sf_dir, "documents"), described))


_OP10_SQL = f"""
WITH RECURSIVE
  worded AS (
    SELECT doc_id, list_filter(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents),
  sets AS (
    SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)) AS shingle FROM worded),
  sizes AS (SELECT doc_id, COUNT(*) AS n FROM sets GROUP BY doc_id),
  common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS shared FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  linked AS (
    SELECT c.a, c.b FROM common c JOIN sizes x ON x.doc_id = c.a JOIN sizes y ON y.doc_id = c.b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
  nodes AS (SELECT doc_id AS node FROM documents),{_REACH},
  least AS (SELECT node, MIN(other) AS component_id FROM reach GROUP BY node)
SELECT l.node AS doc_id, COALESCE(s.n, 0) AS n_shingles, l.component_id FROM least l LEFT JOIN sizes s ON s.doc_id = l.node
"""


@with_sql(_OP10_SQL)
@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op11_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(pieces.round_trip(read(spark, sf_dir, "documents"), vocabulary(pieces.MODEL)))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary(pieces.MODEL))


_LEVELS = 12  # of the SQL below: eight to this power documents a language


def _op13_sql() -> str:
    tampered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR) END"
    digest = "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", "{text}")) + ")"
    sql = f"""
WITH
  crc_bytes AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
  given AS MATERIALIZED (
    SELECT doc_id, lang, {digest.format(text="text")} AS leaf,
           CASE WHEN xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
                                     lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 3 = 0
                THEN {digest.format(text=tampered)} END AS other
    FROM documents, crc_bytes),
  leaves AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS place, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM given),
  n0 AS MATERIALIZED (SELECT tree, place AS i, leaf AS h, COUNT(*) OVER (PARTITION BY tree) AS n FROM leaves)"""

    def level(name: str, below: str) -> str:
        return f""",
  {name} AS MATERIALIZED (
    SELECT *, COUNT(*) OVER (PARTITION BY tree) AS n FROM (SELECT tree, i // 8 AS i, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {below} WHERE n > 1 GROUP BY tree, i // 8))"""

    sql += "".join(level(f"n{k}", f"n{k - 1}") for k in range(1, _LEVELS + 1))
    each = " UNION ALL ".join(f"SELECT tree, h FROM n{k} WHERE n = 1" for k in range(_LEVELS + 1))
    sql += f""",
  subroots AS MATERIALIZED ({each}),
  t0 AS MATERIALIZED (SELECT 0 AS tree, tree AS i, h, COUNT(*) OVER () AS n FROM subroots)"""
    sql += "".join(level(f"t{k}", f"t{k - 1}") for k in range(1, 5))
    roots = " UNION ALL ".join(f"SELECT h FROM t{k} WHERE n = 1" for k in range(5))
    inner = " UNION ALL ".join(f"SELECT {k} AS level, tree, i, h FROM n{k} WHERE n > 1" for k in range(_LEVELS + 1))
    top = " UNION ALL ".join(f"SELECT {100 + k} AS level, i, h FROM t{k} WHERE n > 1" for k in range(5))
    sql += f""",
  inner_nodes AS MATERIALIZED ({inner}),
  top_nodes AS MATERIALIZED ({top}),
  steps AS MATERIALIZED (
    SELECT l.doc_id, s.level, s.i, s.h, s.i = l.place // CAST(pow(8, s.level) AS BIGINT) AS own
    FROM leaves l JOIN inner_nodes s ON s.tree = l.tree AND s.i // 8 = l.place // CAST(pow(8, s.level + 1) AS BIGINT)
    UNION ALL
    SELECT l.doc_id, s.level, s.i, s.h, s.i = l.tree // CAST(pow(8, s.level - 100) AS BIGINT)
    FROM leaves l JOIN top_nodes s ON s.i // 8 = l.tree // CAST(pow(8, s.level - 99) AS BIGINT)),
  proven AS MATERIALIZED (SELECT doc_id, sha256(COALESCE(string_agg(h, '' ORDER BY level, i) FILTER (NOT own), '')) AS proof_sha256 FROM steps GROUP BY doc_id),
  runs AS MATERIALIZED (
    SELECT doc_id, level, COALESCE(string_agg(h, '' ORDER BY i) FILTER (i < own_i), '') AS l, COALESCE(string_agg(h, '' ORDER BY i) FILTER (i > own_i), '') AS r
    FROM (SELECT *, MAX(CASE WHEN own THEN i END) OVER (PARTITION BY doc_id, level) AS own_i FROM steps) GROUP BY doc_id, level),
  paths AS (SELECT doc_id, list([l, r] ORDER BY level) AS sides FROM runs GROUP BY doc_id)
SELECT v.doc_id, v.leaf, s.h AS subroot, t.h AS root, COALESCE(p.proof_sha256, sha256('')) AS proof_sha256,
       CASE WHEN v.other IS NULL THEN t.h ELSE f.h END AS folded_root, CASE WHEN v.other IS NULL THEN TRUE ELSE f.h = t.h END AS verified
FROM leaves v JOIN subroots s ON s.tree = v.tree CROSS JOIN ({roots}) t LEFT JOIN proven p ON p.doc_id = v.doc_id
LEFT JOIN (
  SELECT l.doc_id, list_reduce(list_prepend([l.other], COALESCE(q.sides, [])), lambda a, s: [sha256(s[1] || a[1] || s[2])])[1] AS h
  FROM leaves l LEFT JOIN paths q ON q.doc_id = l.doc_id) f ON f.doc_id = v.doc_id
"""
    return sql


@with_sql(_op13_sql())
@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    trees, top = merkle.manifest(read(spark, sf_dir, "documents"), changed=("text", lowered, fold("doc_id", 3) == 0))
    return merkle.proofs(trees, top).withColumnRenamed("id", "doc_id")

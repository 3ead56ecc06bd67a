"""Layer queries: bronze -> silver casts and dedupe, upserts, conform."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.operators.conform import standardise
from tidemark.operators.silver import to_silver
from tidemark.operators.upsert import upsert
from tidemark.plans.catalog import register
from tidemark.plans.oracle import with_proxies
from tidemark.schemas import NULL_TOKENS, feed
from tidemark.sources import bronze_proxies as B
from tidemark.sources.tables import read_table

_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)


def _g(col: str, typ: str) -> str:
    return f"TRY_CAST(CASE WHEN lower({col}) IN ({_TOKENS}) THEN NULL ELSE {col} END AS {typ})"


def _money(cents: str) -> str:
    return f"(CAST(({cents}) // 100 AS VARCHAR) || '.' || lpad(CAST(({cents}) % 100 AS VARCHAR), 2, '0'))"


def _dirty(expr: str, modulus: int, token: str) -> str:
    return f"CASE WHEN day(trading_date) % {modulus} = 0 THEN '{token}' ELSE {expr} END"


def _bronze_load(close: str, where: str, src: str, at: str) -> str:
    return f"""
      SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date,
             {_dirty(_money('open_cents'), 17, '<NA>')} AS open,
             {_dirty(_money('high_cents'), 11, '')} AS high,
             {_money('low_cents')} AS low,
             {_dirty(_money(close), 7, 'NaN')} AS close,
             {_dirty('CAST(volume AS VARCHAR)', 13, 'None')} AS volume,
             {_money('value_cents')} AS value,
             CAST(NULL AS VARCHAR) AS adjusted_close,
             '{src}' AS src_file, TIMESTAMP '{at}' AS loaded_at
      FROM price {where}"""


_BRONZE_PRICE = [
    ("b_price", _bronze_load("close_cents", "", "landing/stock_price_eod/1.parquet", B.LOAD1_AT)
     + " UNION ALL " + _bronze_load("close_cents + 1", f"WHERE day(trading_date) % {B.CORRECTED_DAYS} = 0",
                                    "landing/stock_price_eod/2.parquet", B.LOAD2_AT)),
]


def _silver_price_sql(where: str = "") -> list[tuple[str, str]]:
    return [
        ("b_latest", f"""
          SELECT * FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker, trading_date
                                         ORDER BY loaded_at DESC, src_file DESC) AS rn
            FROM b_price {where}) WHERE rn = 1"""),
        ("s_price", f"""
          SELECT ticker, {_g('trading_date', 'DATE')} AS trading_date,
                 CAST({_g('open', 'DECIMAL(38,4)')} AS DOUBLE) AS open,
                 CAST({_g('high', 'DECIMAL(38,4)')} AS DOUBLE) AS high,
                 CAST({_g('low', 'DECIMAL(38,4)')} AS DOUBLE) AS low,
                 CAST({_g('close', 'DECIMAL(38,4)')} AS DOUBLE) AS close,
                 CAST({_g('volume', 'DECIMAL(38,4)')} AS DOUBLE) AS volume,
                 CAST({_g('value', 'DECIMAL(38,4)')} AS DOUBLE) AS value,
                 CAST(COALESCE({_g('adjusted_close', 'DECIMAL(38,4)')}, {_g('close', 'DECIMAL(38,4)')}) AS DOUBLE)
                   AS adjusted_close
          FROM b_latest"""),
    ]


def _decimals_to_double(df):
    return df.select(*[F.col(c).cast("double").alias(c) if dict(df.dtypes)[c].startswith("decimal") else F.col(c)
                       for c in df.columns])


@register("silver_stock_price", with_proxies(["price"], _BRONZE_PRICE + _silver_price_sql(), "SELECT * FROM s_price"))
def silver_stock_price(spark: SparkSession, d: str):
    """PRJ1-PRJ4 + AGG1: newest load per key, null-token guarded casts, close fallback.
    decimal(38,4) silver values are returned as double for cross-engine comparison."""
    s = to_silver(B.bronze_stock_price(spark, d), "stock_price_eod", audit=False)
    return _decimals_to_double(s)


@register("silver_partition_load", with_proxies(
    ["price"], _BRONZE_PRICE + _silver_price_sql("WHERE src_file = 'landing/stock_price_eod/2.parquet'"),
    "SELECT * FROM s_price"))
def silver_partition_load(spark: SparkSession, d: str):
    """PRJ8: incremental silver build from one bronze load partition only."""
    s = to_silver(B.bronze_stock_price(spark, d), "stock_price_eod", part_key="2024-01-02", audit=False)
    return _decimals_to_double(s)


_UPSERT_SQL = with_proxies(["price"], _BRONZE_PRICE + [
    ("u_old", f"""
      SELECT ticker, {_g('trading_date', 'DATE')} AS trading_date,
             CAST({_g('close', 'DECIMAL(38,4)')} AS DOUBLE) AS close,
             TIMESTAMP '{B.LOAD1_AT}' AS created_at, 'day1' AS created_by_job,
             TIMESTAMP '{B.LOAD1_AT}' AS updated_at, 'day1' AS updated_by_job
      FROM b_price WHERE src_file = 'landing/stock_price_eod/1.parquet'"""),
    ("u_new", f"""
      SELECT ticker, {_g('trading_date', 'DATE')} AS trading_date,
             CAST({_g('close', 'DECIMAL(38,4)')} AS DOUBLE) AS close,
             TIMESTAMP '{B.LOAD2_AT}' AS created_at, 'day2' AS created_by_job,
             TIMESTAMP '{B.LOAD2_AT}' AS updated_at, 'day2' AS updated_by_job
      FROM b_price WHERE src_file = 'landing/stock_price_eod/2.parquet'"""),
], """
    SELECT COALESCE(o.ticker, n.ticker) AS ticker, COALESCE(o.trading_date, n.trading_date) AS trading_date,
           CASE WHEN n.ticker IS NOT NULL THEN n.close ELSE o.close END AS close,
           CASE WHEN o.ticker IS NOT NULL THEN o.created_at ELSE n.created_at END AS created_at,
           CASE WHEN o.ticker IS NOT NULL THEN o.created_by_job ELSE n.created_by_job END AS created_by_job,
           CASE WHEN n.ticker IS NOT NULL THEN n.updated_at ELSE o.updated_at END AS updated_at,
           CASE WHEN n.ticker IS NOT NULL THEN n.updated_by_job ELSE o.updated_by_job END AS updated_by_job
    FROM u_old o FULL OUTER JOIN u_new n ON o.ticker = n.ticker AND o.trading_date = n.trading_date""")


@register("upsert_keep_created", _UPSERT_SQL)
def upsert_keep_created(spark: SparkSession, d: str):
    """SNK7: merge day-2 corrections into day-1 silver; created_* kept from the old row."""
    bronze = B.bronze_stock_price(spark, d)
    cols = ["ticker", "trading_date", "close", "created_at", "created_by_job", "updated_at", "updated_by_job"]

    def day(src: str, at: str, job: str):
        s = to_silver(bronze.where(F.col("src_file") == src), "stock_price_eod", job=job, user="loader", at=at)
        return _decimals_to_double(s).select(*cols)

    old = day("landing/stock_price_eod/1.parquet", B.LOAD1_AT, "day1")
    new = day("landing/stock_price_eod/2.parquet", B.LOAD2_AT, "day2")
    return upsert(old, new, feed("stock_price_eod").keys, keep_from_old=("created_at", "created_by_job"))


_EVENTS_SQL = with_proxies(["corp_events"], [], f"""
    SELECT event_id, ticker, event_type,
           CASE WHEN ex IN ('', 'None') OR ex IS NULL THEN NULL ELSE {_g('ex', 'DATE')} END AS ex_right_date,
           CASE WHEN rec IN ('', 'None') OR rec IS NULL THEN NULL ELSE {_g('rec', 'DATE')} END AS record_date,
           'event ' || event_id AS event_details
    FROM (SELECT *, COALESCE(CAST(ex_right_date AS VARCHAR), 'None') AS ex,
                    COALESCE(CAST(record_date AS VARCHAR), '') AS rec FROM corp_events)""")


@register("silver_corporate_events", _EVENTS_SQL)
def silver_corporate_events(spark: SparkSession, d: str):
    """PRJ3: dates arriving as 'None' / '' become NULL."""
    return to_silver(B.bronze_corporate_events(spark, d), "corporate_events", audit=False)


_CONFORM_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
           CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
           substring(o_orderpriority, 1, 5) AS o_orderpriority,
           CAST(NULL AS VARCHAR) AS o_comment
    FROM orders"""


@register("conform_columns", _CONFORM_SQL)
def conform_columns(spark: SparkSession, d: str):
    """STD1-STD4: case-insensitive column match, declared order, missing -> NULL,
    extras dropped, exact null tokens -> NULL, text capped (here at 5 chars)."""
    o = read_table(spark, d, "orders")
    landing = o.select(
        F.col("o_orderkey").alias("O_ORDERKEY"),
        F.when(F.col("o_orderkey") % 10 == 3, F.lit("NaN")).otherwise(F.col("o_orderstatus")).alias("O_OrderStatus"),
        "o_orderpriority", "o_totalprice",
    )
    return standardise(landing, ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_comment"], max_len=5)


@register("stream_silver", with_proxies(["price"], _BRONZE_PRICE + _silver_price_sql(), "SELECT * FROM s_price"))
def stream_silver(spark: SparkSession, d: str):
    """STR1-STR6 end to end: the two bronze loads land as ``batch_date=``
    partitions under the session's checkpoint folder, an ``availableNow`` file
    stream loads them into bronze and refreshes silver with latest-load-wins +
    upsert; the silver table must equal the batch silver build."""
    import uuid

    from tidemark.session import ensure_checkpoint_dir
    from tidemark.streaming.landing import start_landing_stream

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    cols = feed("stock_price_eod").bronze_columns
    bronze = B.bronze_stock_price(spark, d)
    for src, day in (("landing/stock_price_eod/1.parquet", "2024-01-01"),
                     ("landing/stock_price_eod/2.parquet", "2024-01-02")):
        bronze.where(F.col("src_file") == src).select(*cols).write.mode("overwrite").parquet(
            f"{root}/landing/batch_date={day}")
    q = start_landing_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/stream_ckpt",
                             "stock_price_eod", silver_path=f"{root}/silver")
    q.awaitTermination()
    silver = spark.read.parquet(f"{root}/silver")
    return _decimals_to_double(silver.select(*cols))


_STREAM_FILES = 40  # more than one micro-batch takes


@register("stream_bronze", with_proxies(["price"], _BRONZE_PRICE, f"""
    SELECT {", ".join(feed("stock_price_eod").bronze_columns)},
           CASE WHEN src_file = 'landing/stock_price_eod/1.parquet' THEN '2024-01-01' ELSE '2024-01-02' END AS part_key
    FROM b_price"""))
def stream_bronze(spark: SparkSession, d: str):
    """STR1/STR3: a landing date of more files than a micro-batch takes, a second date, and a
    late file for the first date after it was loaded; bronze must hold every landed row once."""
    import uuid

    from tidemark.session import ensure_checkpoint_dir
    from tidemark.streaming.landing import start_landing_stream

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    cols = feed("stock_price_eod").bronze_columns
    rows = B.bronze_stock_price(spark, d)
    one, two = (rows.where(F.col("src_file") == f"landing/stock_price_eod/{k}.parquet").select(*cols) for k in (1, 2))
    late = F.substring("trading_date", 9, 2) == "05"

    def land(df, day: str, files: int) -> None:
        df.repartition(files, "ticker", "trading_date").write.mode("append").parquet(f"{root}/landing/batch_date={day}")

    def load() -> None:
        start_landing_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/stream_ckpt", "stock_price_eod").awaitTermination()

    land(one.where(~late), "2024-01-01", _STREAM_FILES)
    land(two, "2024-01-02", 4)
    load()
    land(one.where(late), "2024-01-01", 2)
    load()
    return spark.read.parquet(f"{root}/bronze").select(*cols, F.col("part_key").cast("string").alias("part_key"))


@register("stream_dead_letters", with_proxies(["price"], _BRONZE_PRICE, """
    SELECT ticker, trading_date, close, CASE WHEN late THEN 'no batch date' ELSE 'loaded' END AS state, CASE WHEN late THEN 1 ELSE 0 END AS batches
    FROM (SELECT *, substr(trading_date, 9, 2) = '05' AS late FROM b_price WHERE src_file = 'landing/stock_price_eod/1.parquet')
    UNION ALL
    SELECT ticker, trading_date, close, 'loaded', 0 FROM b_price WHERE src_file = 'landing/stock_price_eod/1.parquet' AND substr(trading_date, 9, 2) = '05'"""))
def stream_dead_letters(spark: SparkSession, d: str):
    """STR4: rows without a batch date are kept aside with the reason; fed again with one, they load once."""
    import uuid

    from tidemark.session import ensure_checkpoint_dir
    from tidemark.streaming.landing import committed, dead_letter_path, start_landing_stream

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/letters-{uuid.uuid4().hex}"
    rows = B.bronze_stock_price(spark, d).where(F.col("src_file") == "landing/stock_price_eod/1.parquet").select(*feed("stock_price_eod").bronze_columns)
    late = F.substring("trading_date", 9, 2) == "05"

    def load() -> None:
        start_landing_stream(spark, f"{root}/landing", f"{root}/bronze", f"{root}/stream_ckpt", "stock_price_eod").awaitTermination()

    rows.where(~late).write.parquet(f"{root}/landing/batch_date=2024-01-01")
    rows.where(late).write.parquet(f"{root}/landing/batch_date=__HIVE_DEFAULT_PARTITION__")
    load()
    rows.where(late).write.parquet(f"{root}/landing/batch_date=2024-01-05")
    load()
    loaded = committed(spark, f"{root}/bronze").select("ticker", "trading_date", "close", F.lit("loaded").alias("state"), F.lit(0).alias("batches"))
    aside = spark.read.parquet(dead_letter_path(f"{root}/bronze"))
    return loaded.unionByName(aside.select("ticker", "trading_date", "close", F.col("reason").alias("state"), F.lit(1).alias("batches")))

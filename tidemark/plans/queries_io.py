"""Queries that write a table, or vendor-shaped frames of it, and read or normalise them back.

Everything is written under a fresh folder of the session's checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import load as L
from tidemark.operators import normalise as N
from tidemark.operators.silver import up_to_batch
from tidemark.plans.catalog import register
from tidemark.plans.oracle import with_proxies
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import proxies as P
from tidemark.sources import readers as R
from tidemark.sources import text as X
from tidemark.sources.tables import read_table


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _cents(c: str) -> Column:
    """A price text as integer cents: engines write the same number in different ways."""
    return F.round(F.col(c).cast("double") * 100).cast("bigint").alias(f"{c}_cents")


# -- vendor frames -> feed columns (NRM1, NRM2, NRM4-NRM11) ---------------------------------
@register("normalise_price", with_proxies(["price"], [], """
    SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, CAST(volume AS VARCHAR) AS volume, open_cents, high_cents, low_cents, close_cents,
           CAST(NULL AS VARCHAR) AS value, CAST(NULL AS VARCHAR) AS adjusted_close FROM price"""))
def normalise_price(spark: SparkSession, d: str) -> DataFrame:
    """NRM1: vendor time stamps cut to the day, the ticker from the request."""
    raw = P.stock_price_eod(spark, d).select(F.col("ticker").alias("symbol"), F.concat(F.col("trading_date").cast("string"), F.lit("T00:00:00")).alias("time"),
                                             "open", "high", "low", "close", "volume")
    return N.norm_stock_price(raw).select("ticker", "trading_date", "volume", *[_cents(c) for c in ("open", "high", "low", "close")], "value", "adjusted_close")


@register("normalise_index", with_proxies(["idx"], [], """
    SELECT name AS index_name, CAST(trading_date AS VARCHAR) AS trading_date, CAST(ROUND(close * 100) AS BIGINT) AS close_cents,
           CAST(NULL AS VARCHAR) AS open FROM idx, (VALUES ('VNINDEX'), ('HNXINDEX')) v(name)"""))
def normalise_index(spark: SparkSession, d: str) -> DataFrame:
    """NRM2: the default index list keeps two of three series."""
    names = F.explode(F.array(F.lit("VNINDEX"), F.lit("HNXINDEX"), F.lit("OTHER"))).alias("symbol")
    raw = P.index_price_eod(spark, d).select(names, F.col("trading_date").cast("string").alias("time"), "close", "volume")
    return N.norm_index_price(raw).select("index_name", "trading_date", _cents("close"), "open")


@register("normalise_prop", with_proxies(["prop_flow"], [], """
    SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, '0' AS buy_vol, '0' AS sell_vol, CAST(net_val AS VARCHAR) AS net_val FROM prop_flow"""))
def normalise_prop(spark: SparkSession, d: str) -> DataFrame:
    """NRM4: net-only desk flows; days without a net are dropped."""
    f = P.proprietary_trading(spark, d)
    raw = f.select(F.col("ticker").alias("symbol"), F.concat(F.col("trading_date").cast("string"), F.lit("T00:00:00Z")).alias("date"),
                   F.explode(F.array(F.col("net_val"), F.lit(0).cast("bigint"))).alias("propTradingNetValue"))
    return N.norm_prop_flow(raw)


@register("normalise_profile", with_proxies(["profile"], [], "SELECT ticker, 'Company ' || ticker AS company_name, industry, 'HOSE' AS exchange FROM profile"))
def normalise_profile(spark: SparkSession, d: str) -> DataFrame:
    """NRM5: vendor names, a missing share count and description tolerated."""
    p = P.company_profile(spark, d)
    return N.norm_profile(p.select(F.col("ticker").alias("symbol"), F.col("company_name").alias("organ_name"), F.col("industry").alias("sector"),
                                   F.col("exchange").alias("com_group_code")))


@register("normalise_events", with_proxies(["corp_events"], [], """
    SELECT event_id, CASE WHEN CAST(event_id AS BIGINT) % 2 = 0 THEN 'REQ' ELSE ticker END AS ticker, event_type,
           CAST(ex_right_date AS VARCHAR) AS ex_right_date, CAST(record_date AS VARCHAR) AS record_date FROM corp_events"""))
def normalise_events(spark: SparkSession, d: str) -> DataFrame:
    """NRM6: an absent ticker is filled with the requested symbol."""
    e = P.corporate_events(spark, d)
    raw = e.select(F.col("event_id").alias("id"), F.when(F.col("event_id").cast("bigint") % 2 != 0, F.col("ticker")).alias("ticker"), F.lit("REQ").alias("symbol"),
                   F.col("event_type").alias("category"), F.col("ex_right_date").alias("exright_date"), "record_date")
    return N.norm_events(raw).drop("event_details")


@register("normalise_news", with_proxies(["news"], [], """
    SELECT article_id, CASE WHEN CAST(ticker AS BIGINT) % 3 = 0 THEN 'S' || ticker ELSE ticker END AS ticker, 'Article ' || article_id AS title FROM news"""))
def normalise_news(spark: SparkSession, d: str) -> DataFrame:
    """NRM7: the ticker is filled only for symbols none of whose articles has one."""
    n = P.news_articles(spark, d)
    raw = n.select(F.col("article_id").alias("id"), F.concat(F.lit("S"), F.col("ticker")).alias("symbol"),
                   F.when(F.col("ticker").cast("bigint") % 3 != 0, F.col("ticker")).alias("ticker"), F.col("title").alias("news_title"))
    return N.norm_news(raw).select("article_id", "ticker", "title")


@register("normalise_reports", with_proxies(["analyst"], [], """
    SELECT report_id, CASE WHEN CAST(report_id AS BIGINT) % 2 = 0 THEN 'REQ' ELSE ticker END AS ticker, 'Broker' AS brokerage_firm,
           CAST(publish_date AS VARCHAR) AS publish_date FROM analyst"""))
def normalise_reports(spark: SparkSession, d: str) -> DataFrame:
    """NRM8: an empty vendor symbol falls back to the request."""
    r = P.analyst_reports(spark, d)
    raw = r.select(F.col("report_id").cast("bigint").alias("reportID"), F.when(F.col("report_id").cast("bigint") % 2 == 0, "").otherwise(F.col("ticker")).alias("symbol"),
                   F.lit("REQ").alias("asked"), F.col("brokerage_firm").alias("sourceName"), F.col("publish_date").alias("date"))
    return N.norm_reports(raw, F.col("asked")).select("report_id", "ticker", "brokerage_firm", "publish_date")


def _codes_sql(codes: dict[str, str], names: dict[str, str]) -> str:
    """Code of each proxy series, then our name of that code; a code without a name stays."""
    back = {c: n for n, c in codes.items()}
    return " ".join(f"WHEN '{own}' THEN '{back.get(code, code)}'" for own, code in names.items())


_QUOTES = {"Brent Crude": "BZ=F", "WTI": "CL=F", "Gold": "GC=F", "Steel HRC": "HR=F", "Gasoline RON95 Singapore": "RB=F", "Baltic Dirty Tanker Index": "??"}


@register("normalise_commodities", with_proxies(["commodities"], [], f"""
    SELECT CASE commodity_name {_codes_sql(N.COMMODITY_CODES, _QUOTES)} END AS commodity_name, CAST(date AS VARCHAR) AS date, CAST(ROUND(price * 100) AS BIGINT) AS price_cents FROM commodities"""))
def normalise_commodities(spark: SparkSession, d: str) -> DataFrame:
    """NRM9: quote codes by the default mapping; a code it lacks is kept as it is."""
    c = P.commodities_price(spark, d)
    code = F.create_map(*[F.lit(x) for kv in _QUOTES.items() for x in kv])[F.col("commodity_name")]
    raw = c.select(code.alias("symbol"), F.col("date").cast("timestamp").alias("Date"), F.col("price").alias("Close"))
    return N.norm_quotes(raw, N.COMMODITY_CODES, "commodity_name", "price").select("commodity_name", "date", _cents("price"))


_PAIRS = {"USD/VND": "USDVND=X", "EUR/VND": "EURVND=X", "GBP/VND": "GBPVND=X"}


@register("normalise_fx", with_proxies(["fx"], [], f"SELECT CASE pair {_codes_sql(N.CURRENCY_CODES, _PAIRS)} END AS pair, CAST(date AS VARCHAR) AS date, CAST(ROUND(exchange_rate * 100) AS BIGINT) AS exchange_rate_cents FROM fx"))
def normalise_fx(spark: SparkSession, d: str) -> DataFrame:
    """NRM10: FX quote codes by the default mapping."""
    code = F.create_map(*[F.lit(x) for kv in _PAIRS.items() for x in kv])[F.col("pair")]
    raw = P.exchange_rates(spark, d).select(code.alias("symbol"), F.col("date").cast("timestamp").alias("Date"), F.col("exchange_rate").alias("Close"))
    return N.norm_quotes(raw, N.CURRENCY_CODES, "pair", "exchange_rate").select("pair", "date", _cents("exchange_rate"))


@register("normalise_rates", with_proxies(["rates"], [], """
    SELECT CASE rate_type WHEN '^IRX' THEN 'us_fed_funds_rate' WHEN '^TNX' THEN 'us_10y_treasury' WHEN '^FVX' THEN 'us_5y_treasury' END AS rate_type,
           CAST(date AS VARCHAR) AS date, CAST(ROUND(rate_value * 100) AS BIGINT) AS rate_value_cents FROM rates"""))
def normalise_rates(spark: SparkSession, d: str) -> DataFrame:
    """NRM11: benchmark rates by the default mapping."""
    raw = P.interest_rates(spark, d).select(F.col("rate_type").alias("symbol"), F.col("date").cast("timestamp").alias("Date"), F.col("rate_value").alias("Close"))
    return N.norm_quotes(raw, N.RATE_CODES, "rate_type", "rate_value").select("rate_type", "date", _cents("rate_value"))


# -- files out and in (SRC1-SRC7, SNK1-SNK6, SNK14, CLN1-CLN3) --------------------------------
_ORDER = ("o_orderkey", "o_orderpriority", "note")
_NOTE_SQL = "o_orderstatus || ', \"' || o_orderpriority || '\"' || chr(10) || 'in two lines'"


def _noted_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders with a text that holds separators, quotes and a line end."""
    note = F.concat("o_orderstatus", F.lit(', "'), "o_orderpriority", F.lit('"\nin two lines'))
    return read_table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderpriority", note.alias("note"))


def _quoted_csv(df: DataFrame, folder: str) -> None:
    df.write.mode("append").options(header=True, quoteAll=True, escape='"').csv(folder)


def _raw_csv(header: str, lines: DataFrame, folder: str) -> None:
    """Lines as they are: the header is the one column's name, and nothing separates or quotes."""
    lines.select(lines.columns[0]).toDF(header).write.mode("append").options(header=True, sep="\u0001", quote="\u0002").csv(folder)


@register("csv_by_header", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 5 <> 3 THEN o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderkey % 5 < 2 THEN {_NOTE_SQL} END AS note
    FROM orders WHERE o_orderkey % 5 <> 4""")
def csv_by_header(spark: SparkSession, d: str) -> DataFrame:
    """SRC6: files with another order of columns, without one, with quoted separators and line ends,
    with short records (missing fields are NULL) and long ones (dropped)."""
    o = _noted_orders(spark, d)
    kind = F.col("o_orderkey").cast("bigint") % 5
    folder = _folder(spark, "csv")
    for k, order in enumerate((_ORDER, _ORDER[::-1], _ORDER[:2])):
        _quoted_csv(o.where(kind == k).select(*order), folder)
    _raw_csv("o_orderkey,o_orderpriority", o.where(kind == 3).select("o_orderkey"), folder)
    _raw_csv("o_orderkey,o_orderpriority", o.where(kind == 4).select(F.concat_ws(",", "o_orderkey", F.lit("a"), F.lit("b"))), folder)
    return R.read_csv_folder(spark, folder)


@register("mixed_folder", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS o_orderpriority,
           CASE WHEN o_orderkey % 3 = 2 THEN 'a,b,c,d' ELSE {_NOTE_SQL} END AS note FROM orders""")
def mixed_folder(spark: SparkSession, d: str) -> DataFrame:
    """SRC7: CSV and Parquet files of one folder by name, all text; a good record with fewer fields
    and quoted separators stays."""
    o = _noted_orders(spark, d)
    kind = F.col("o_orderkey").cast("bigint") % 3
    folder = _folder(spark, "mixed")
    o.where(kind == 0).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint")).write.mode("append").parquet(folder)
    _quoted_csv(o.where(kind == 1).select("note", "o_orderkey"), folder)
    _raw_csv("note,o_orderkey,o_orderpriority", o.where(kind == 2).select(F.concat(F.lit('"a,b,c,d",'), "o_orderkey")), folder)
    return R.read_mixed_folder(spark, folder)


@register("landing_to_bronze", """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, '2026-01-0' || CAST(o_orderkey % 3 + 1 AS VARCHAR) AS part_key,
           o_orderkey % 3 = 0 AS corrected, TRUE AS from_landing, 1 AS loads
    FROM orders WHERE o_orderkey % 3 < 2""")
def landing_to_bronze(spark: SparkSession, d: str) -> DataFrame:
    """SNK1-SNK6 + SRC1: landing files per batch date, loaded twice; a correction of the first date
    replaces its rows, an empty delivery for the third removes them; lineage names each row's file."""
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus")
    root = _folder(spark, "landing")
    days = ("2026-01-01", "2026-01-02", "2026-01-03")
    own = {day: o.where(F.col("o_orderkey").cast("bigint") % 3 == k).withColumn("corrected", F.lit(False)) for k, day in enumerate(days)}
    files = lambda day: R.read_bronze(spark, f"{root}/ORDERS/batch_date={day}", "parquet", own[day].schema)
    for _ in range(2):
        for day in days:
            L.write_landing(own[day], root, "ORDERS", day)
            L.load_bronze(files(day), f"{root}/bronze", day)
    L.write_landing(own[days[0]].withColumn("corrected", F.lit(True)), root, "ORDERS", days[0])
    L.load_bronze(files(days[0]), f"{root}/bronze", days[0])
    L.load_bronze(own[days[2]].where("false"), f"{root}/bronze", days[2], src_file="empty")
    bronze = spark.read.parquet(f"{root}/bronze").withColumn("part_key", F.col("part_key").cast("string"))
    rows = bronze.groupBy("o_orderkey", "o_orderstatus", "part_key", "corrected").agg(
        F.min(F.contains("src_file", F.concat(F.lit("batch_date="), F.col("batch_date").cast("string")))).alias("from_landing"),
        F.countDistinct("src_row").cast("int").alias("loads"))
    return rows


@register("bronze_full_reload", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(NULL AS VARCHAR) AS part_key FROM orders WHERE o_orderstatus = 'F'")
def bronze_full_reload(spark: SparkSession, d: str) -> DataFrame:
    """SNK4: a load without a batch date replaces the whole table, whatever partitions it had."""
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus")
    path = _folder(spark, "reload")
    L.load_bronze(o.drop("o_orderstatus"), path, "2026-01-01", src_file="first")
    L.load_bronze(o.where("o_orderstatus = 'F'").drop("o_orderstatus"), path, None, src_file="second")
    return spark.read.schema("o_orderkey string, part_key string").parquet(path)


@register("json_to_bronze", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders")
def json_to_bronze(spark: SparkSession, d: str) -> DataFrame:
    """SRC2: JSON lines whose field names differ in case."""
    o = read_table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("O_OrderKey"), F.col("o_orderpriority").alias("O_ORDERPRIORITY"))
    folder = _folder(spark, "json")
    o.write.json(folder)
    return R.read_bronze(spark, folder, "json", o.toDF("o_orderkey", "o_orderpriority").schema)


@register("clean_text_files", r"""
    SELECT doc_id, COUNT(*) AS n_lines FROM (
      SELECT doc_id, unnest(string_split(replace(text, chr(10), ' ') || chr(10) || 'x' || chr(10) || 'tail', chr(10))) AS line FROM documents)
    GROUP BY doc_id""")
def clean_text_files(spark: SparkSession, d: str) -> DataFrame:
    """CLN1 + CLN3: text files with injected NULs and bad lines; what is left has neither."""
    docs = read_table(spark, d, "documents").select("doc_id", F.regexp_replace("text", "[\r\n]", " ").alias("text"))
    folder = _folder(spark, "lines")
    body = F.concat(F.col("doc_id").cast("string"), F.lit("\t"))
    lines = docs.select(F.explode(F.array(F.concat(body, "text"), F.concat(body, F.lit("x\u0000")), F.concat(body, F.lit(f"an {X.BAD_LINE} here")),
                                          F.concat(body, F.lit("tail")))).alias("value"))
    lines.write.text(folder)
    clean = X.drop_lines(X.strip_nul(X.read_lines(spark, folder)))
    clean = clean.where(~F.col("value").contains("\u0000"))
    return clean.groupBy(F.substring_index("value", "\t", 1).cast("bigint").alias("doc_id")).agg(F.count("*").alias("n_lines"))


@register("published_forecast", """
    SELECT 'C' || CAST(c_custkey AS VARCHAR) AS ticker, CAST(CAST(c_acctbal AS DECIMAL(18,6)) AS DOUBLE) AS predicted_return, 'v2' AS model_version,
           DATE '2026-01-02' AS trading_date FROM customer""")
def published_forecast(spark: SparkSession, d: str) -> DataFrame:
    """SNK12 + SNK13: predictions as JSON lines, published twice; the second run replaces the date."""
    c = read_table(spark, d, "customer")
    folder = _folder(spark, "forecast")
    own = c.select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ticker"), F.col("c_acctbal").alias("predicted_return"))
    own.select(F.to_json(F.struct("ticker", "predicted_return")).alias("value")).write.text(f"{folder}/lines")
    for version in ("v1", "v2"):
        L.publish_forecast(L.forecast_rows(L.read_predictions(spark, f"{folder}/lines"), "2026-01-02", version), f"{folder}/table")
    out = spark.read.parquet(f"{folder}/table")
    return out.select("ticker", F.col("predicted_return").cast("double").alias("predicted_return"), "model_version", "trading_date")


@register("appended_csv", "SELECT o_orderkey, o_orderpriority FROM orders")
def appended_csv(spark: SparkSession, d: str) -> DataFrame:
    """SNK14: CSV files appended per key value, read back with the key from the folder name."""
    folder = _folder(spark, "append")
    o = read_table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    for half in (0, 1):
        L.append_partitioned(o.where(F.col("o_orderkey") % 2 == half), folder, ["o_orderpriority"])
    return spark.read.schema("o_orderkey bigint, o_orderpriority string").option("header", True).csv(folder)


# -- slices of a feed (NRM18, NRM19, PRJ9) and the vendor's wide layout (NRM15) ----------------
@register("universe_slice", with_proxies(["price", "profile"], [], """
    SELECT ticker, trading_date, volume FROM price
    WHERE trading_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'
      AND ticker IN (SELECT ticker FROM profile WHERE CAST(right(ticker, 1) AS INTEGER) % 2 = 0)"""))
def universe_slice(spark: SparkSession, d: str) -> DataFrame:
    """NRM18 + NRM19: rows of a symbol universe inside a date range."""
    symbols = P.company_profile(spark, d).where(F.right("ticker", F.lit(1)).cast("int") % 2 == 0)
    return N.restrict_universe(N.in_range(P.stock_price_eod(spark, d), "trading_date", "1995-01-01", "1996-12-31"), symbols).select(
        "ticker", "trading_date", "volume")


@register("batch_history", with_proxies(["corp_events"], [], """
    SELECT ticker, COUNT(*) AS n FROM corp_events WHERE batch_date <= DATE '2024-01-15' GROUP BY ticker"""))
def batch_history(spark: SparkSession, d: str) -> DataFrame:
    """PRJ9: history up to a batch date only."""
    return up_to_batch(P.corporate_events(spark, d), "2024-01-15").groupBy("ticker").agg(F.count("*").alias("n"))


@register("vendor_periods", """
    SELECT p.o_orderpriority AS item, s.period_label, COUNT(o.o_orderkey) AS value
    FROM (SELECT DISTINCT o_orderpriority FROM orders) p CROSS JOIN (VALUES ('F'), ('O'), ('P')) s(period_label)
    LEFT JOIN orders o ON o.o_orderpriority = p.o_orderpriority AND o.o_orderstatus = s.period_label GROUP BY 1, 2""")
def vendor_periods(spark: SparkSession, d: str) -> DataFrame:
    """NRM15: a vendor's layout of one column per period becomes rows."""
    o = read_table(spark, d, "orders")
    wide = o.groupBy(F.col("o_orderpriority").alias("item")).pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count("o_orderkey")).fillna(0)
    return N.unpivot_periods(wide, ["item"])

"""Landing / backfill queries: vendor normalisers, statement pivots, macro
periods, gap reports, text cleaners and the JSON payload hop."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import gaps as G
from tidemark.operators import load as L
from tidemark.operators import normalise as N
from tidemark.operators import samples as S
from tidemark.plans import marts
from tidemark.plans import oracle_marts as OM
from tidemark.plans.catalog import register
from tidemark.plans.oracle import with_proxies
from tidemark.plans.queries_features import build_model_frame
from tidemark.sources import proxies as P
from tidemark.sources import text as X
from tidemark.sources.readers import lookback_slice
from tidemark.sources.tables import read_table

INCOME_COLS = ("revenue", "cogs", "gross_profit", "operating_expenses", "operating_profit", "financial_income",
               "financial_expenses", "net_profit_after_tax")
_BANK_ONLY_MISSING = ("cogs", "gross_profit")


def _is_bank(ticker: Column) -> Column:
    """Odd brand numbers report with bank labels (a property of the key, no row is dropped)."""
    return F.regexp_extract(ticker, r"(\d+)$", 1).cast("int") % 2 == 1


def _vendor_items(spark: SparkSession, d: str):
    """Income proxy in the vendor's long layout: (ticker, item_en, 'YYYY-Qn', value)."""
    inc = P.income_statement(spark, d)
    long = inc.unpivot(["ticker", "year", "period"], list(INCOME_COLS), "column", "value")
    corp = {v: k for k, v in N.INCOME_MAPS[0].items()}
    bank = {v: k for k, v in N.INCOME_MAPS[1].items()}
    corp_m = F.create_map(*[F.lit(x) for kv in corp.items() for x in kv])
    bank_m = F.create_map(*[F.lit(x) for kv in bank.items() for x in kv])
    label = F.when(_is_bank(F.col("ticker")) & bank_m[F.col("column")].isNotNull(), bank_m[F.col("column")]) \
        .otherwise(corp_m[F.col("column")])
    return long.select("ticker", label.alias("item_en"),
                       F.concat(F.col("year").cast("string"), F.lit("-"), F.col("period")).alias("period_label"),
                       "value")


def _income_text_sql(where: str = "") -> str:
    cols = []
    for c in INCOME_COLS:
        v = f"CAST({c} AS VARCHAR)"
        if c in _BANK_ONLY_MISSING:
            v = f"CASE WHEN CAST(regexp_extract(ticker, '(\\d+)$', 1) AS INTEGER) % 2 = 1 THEN NULL ELSE {v} END"
        cols.append(f"{v} AS {c}")
    return with_proxies(["income"], [], f"""
        SELECT ticker, period, CAST(year AS VARCHAR) AS year, {", ".join(cols)} FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY year DESC, period DESC) AS rn FROM income) {where}""")


@register("statement_pivot", _income_text_sql())
def statement_pivot(spark: SparkSession, d: str):
    """NRM15 + NRM17: label-map choice per symbol (corporate vs bank, most matches
    wins), long vendor items pivoted to one row per (ticker, year, period)."""
    items = _vendor_items(spark, d)
    return N.statement_wide(items, N.label_map_frame(spark, N.INCOME_MAPS), INCOME_COLS)


@register("statement_latest", _income_text_sql("WHERE rn = 1"))
def statement_latest(spark: SparkSession, d: str):
    """NRM16: the newest period of each symbol only."""
    items = _vendor_items(spark, d)
    return N.statement_wide(items, N.label_map_frame(spark, N.INCOME_MAPS), INCOME_COLS, latest_only=True)


# Proxy indicator per order priority and the period text style it reports in.
_MACRO_STYLES = {"1-URGENT": ("vn_gdp_usd", "Y"), "2-HIGH": ("vn_cpi_inflation", "M"),
                 "3-MEDIUM": ("vn_unemployment", "Q"), "4-NOT SPECIFIED": ("vn_m2", "m"),
                 "5-LOW": ("vn_fx_reserve", "Y")}


def _macro_raw(spark: SparkSession, d: str):
    o = read_table(spark, d, "orders").select("o_orderdate", "o_orderpriority")
    y = F.year("o_orderdate").cast("string")
    m = F.month("o_orderdate").cast("string")
    text = None
    name = None
    for pri, (ind, style) in _MACRO_STYLES.items():
        t = {"Y": y, "M": F.concat(y, F.lit("M"), F.lpad(m, 2, "0")), "m": F.concat(y, F.lit("M"), m),
             "Q": F.concat(y, F.lit("Q"), F.quarter("o_orderdate").cast("string"))}[style]
        cond = F.col("o_orderpriority") == pri
        text = F.when(cond, t) if text is None else text.when(cond, t)
        name = F.when(cond, F.lit(ind)) if name is None else name.when(cond, F.lit(ind))
    g = o.groupBy(name.alias("indicator_name"), text.alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("indicator_name", "date",
                    F.when(F.col("n") % 3 == 0, F.lit(None)).otherwise(F.col("n")).alias("value"),
                    F.when(F.col("n") % 2 == 0, F.lit("%")).alias("unit"))


_MACRO_RAW_SQL = [("mr", """
    SELECT indicator_name, date, CASE WHEN n % 3 = 0 THEN NULL ELSE n END AS value,
           CASE WHEN n % 2 = 0 THEN '%' END AS unit,
           CASE WHEN contains(date, 'M') THEN make_date(CAST(substr(date, 1, 4) AS INTEGER),
                                                         CAST(split_part(date, 'M', 2) AS INTEGER), 1)
                WHEN contains(date, 'Q') THEN make_date(CAST(substr(date, 1, 4) AS INTEGER),
                                                         (CAST(split_part(date, 'Q', 2) AS INTEGER) - 1) * 3 + 1, 1)
                WHEN regexp_full_match(date, '\\d{4}') THEN make_date(CAST(date AS INTEGER), 1, 1) END AS report_date
    FROM (
      SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'vn_gdp_usd' WHEN '2-HIGH' THEN 'vn_cpi_inflation'
                  WHEN '3-MEDIUM' THEN 'vn_unemployment' WHEN '4-NOT SPECIFIED' THEN 'vn_m2'
                  WHEN '5-LOW' THEN 'vn_fx_reserve' END AS indicator_name,
             CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN CAST(year(o_orderdate) AS VARCHAR)
                  WHEN o_orderpriority = '2-HIGH'
                    THEN CAST(year(o_orderdate) AS VARCHAR) || 'M' || lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0')
                  WHEN o_orderpriority = '4-NOT SPECIFIED'
                    THEN CAST(year(o_orderdate) AS VARCHAR) || 'M' || CAST(month(o_orderdate) AS VARCHAR)
                  WHEN o_orderpriority = '3-MEDIUM'
                    THEN CAST(year(o_orderdate) AS VARCHAR) || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) END AS date,
             COUNT(*) AS n
      FROM orders GROUP BY 1, 2)""")]


@register("macro_latest", with_proxies([], _MACRO_RAW_SQL, """
    SELECT indicator_name, CAST(report_date AS VARCHAR) AS report_date, CAST(value AS VARCHAR) AS value,
           COALESCE(unit, '') AS unit
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY indicator_name ORDER BY report_date DESC) AS rn
          FROM mr WHERE value IS NOT NULL) WHERE rn = 1"""))
def macro_latest(spark: SparkSession, d: str):
    """NRM12 + NRM14: newest non-null record per indicator; period text -> date."""
    return N.latest_non_null_macro(_macro_raw(spark, d))


@register("macro_history", with_proxies([], _MACRO_RAW_SQL, """
    SELECT indicator_name, CAST(report_date AS VARCHAR) AS report_date, CAST(value AS VARCHAR) AS value,
           COALESCE(unit, '') AS unit
    FROM mr WHERE value IS NOT NULL AND report_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"""))
def macro_history(spark: SparkSession, d: str):
    """NRM13: every non-null record inside a date range."""
    return N.macro_history(_macro_raw(spark, d), "1996-01-01", "1999-12-31")


def _reports(spark: SparkSession, d: str, loaded: bool):
    """Customers' order quarters; the first run saw only the orders that were no longer pending."""
    o = read_table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderdate")
    if loaded:
        o = o.where(F.col("o_orderstatus") != "P")
    return o.select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"), F.year("o_orderdate").alias("year"),
                    F.concat(F.lit("Q"), F.quarter("o_orderdate").cast("string")).alias("period")).distinct()


def _universe(spark: SparkSession, d: str):
    return read_table(spark, d, "customer").select(F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("ticker"))


_QI = "year(o_orderdate) * 4 + quarter(o_orderdate) - 1"


def _gaps_sql(where: str, run: int) -> str:
    return f"""
      SELECT 'orders' AS table_name, symbol, CAST(floor(qi / 4) AS INTEGER) AS year,
             'Q' || CAST(qi % 4 + 1 AS VARCHAR) AS period, 'no report for the quarter' AS reason, {run} AS run_id
      FROM (
        SELECT 'C' || CAST(c_custkey AS VARCHAR) AS symbol, qi FROM customer,
          (SELECT unnest(generate_series(MIN({_QI}), MAX({_QI}))) AS qi FROM orders {where})
        EXCEPT
        SELECT 'C' || CAST(o_custkey AS VARCHAR), {_QI} FROM orders {where})"""


@register("gap_report", with_proxies([], [("g1", _gaps_sql("WHERE o_orderstatus <> 'P'", 1)), ("g2", _gaps_sql("", 2))], """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY table_name, symbol, year, period ORDER BY run_id DESC) AS rn
      FROM (SELECT * FROM g1 UNION ALL SELECT * FROM g2)) WHERE rn = 1"""))
def gap_report(spark: SparkSession, d: str):
    """SNK17/SNK18: quarters in which a customer has no order, customers without any order
    included; two runs (before and after the pending orders), the newest run kept."""
    known = _universe(spark, d)
    run1 = G.quarterly_gaps(_reports(spark, d, True), "orders", universe=known).withColumn("run_id", F.lit(1))
    run2 = G.quarterly_gaps(_reports(spark, d, False), "orders", universe=known).withColumn("run_id", F.lit(2))
    return G.gap_report(run1, run2)


@register("gap_intervals", with_proxies([], [("gi", _gaps_sql("", 1)), ("gq", "SELECT *, year * 4 + CAST(right(period, 1) AS INTEGER) - 1 AS qi FROM gi")], """
    SELECT table_name, symbol, CAST(MIN(qi) AS BIGINT) AS first_quarter, CAST(MAX(qi) AS BIGINT) AS last_quarter, COUNT(*) AS length, MAX(reason) AS reason
    FROM (SELECT *, qi - ROW_NUMBER() OVER (PARTITION BY symbol ORDER BY qi) AS island FROM gq) GROUP BY table_name, symbol, island"""))
def gap_intervals(spark: SparkSession, d: str):
    """SNK18: the same gaps as runs of quarters, one row a run."""
    out = G.gap_intervals(_reports(spark, d, False), "orders", universe=_universe(spark, d))
    return out.select("table_name", "symbol", *[F.col(c).cast("bigint").alias(c) for c in ("first_quarter", "last_quarter", "length")], "reason")


@register("own_span_gaps", with_proxies([], [("os_q", f"SELECT DISTINCT 'C' || CAST(o_custkey AS VARCHAR) AS symbol, {_QI} AS qi FROM orders")], """
    SELECT 'orders' AS table_name, symbol, CAST(floor(qi / 4) AS INTEGER) AS year,
           'Q' || CAST(qi % 4 + 1 AS VARCHAR) AS period, 'no report for the quarter' AS reason
    FROM (SELECT symbol, unnest(generate_series(MIN(qi), MAX(qi))) AS qi FROM os_q GROUP BY symbol
          EXCEPT SELECT symbol, qi FROM os_q)"""))
def own_span_gaps(spark: SparkSession, d: str):
    """SNK18: quarters missing between a customer's first and last order."""
    return G.quarterly_gaps(_reports(spark, d, False), "orders")


@register("pending_units", """
    SELECT DISTINCT 'C' || CAST(o_custkey AS VARCHAR) AS ticker, year(o_orderdate) AS year FROM orders
    EXCEPT SELECT 'C' || CAST(o_custkey AS VARCHAR), year(o_orderdate) FROM orders WHERE o_orderstatus = 'F'""")
def pending_units(spark: SparkSession, d: str):
    """SNK16: (symbol, year) units that no finished load covers yet."""
    o = read_table(spark, d, "orders").select(F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("ticker"),
                                              F.year("o_orderdate").alias("year"), "o_orderstatus")
    return G.pending(o.select("ticker", "year").distinct(), o.where(F.col("o_orderstatus") == "F"), ["ticker", "year"])


@register("strip_and_drop_lines", """
    SELECT doc_id, COUNT(*) AS n_lines,
           COUNT(CASE WHEN NOT contains(line, 'invalid formula') THEN 1 END) AS n_kept,
           CAST(COALESCE(SUM(CASE WHEN NOT contains(line, 'invalid formula') THEN length(line) END), 0) AS BIGINT)
             AS kept_chars
    FROM (SELECT doc_id, unnest(string_split(replace(text, chr(0), ''), chr(10))) AS line FROM documents)
    GROUP BY doc_id""")
def strip_and_drop_lines(spark: SparkSession, d: str):
    """CLN1 + CLN3 over every line of every document: NUL removed, lines with the
    bad-line marker dropped; per-document line and character counts."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    lines = docs.select("doc_id", F.explode(F.split(F.col("text"), "\n", -1)).alias("value"))
    clean = X.strip_nul(lines)
    keep = ~F.col("value").contains(X.BAD_LINE)
    return clean.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(keep).alias("n_kept"),
        F.coalesce(F.sum(F.when(keep, F.length("value"))), F.lit(0)).cast("bigint").alias("kept_chars"),
    )


@register("json_roundtrip", with_proxies(OM.FACT_PROXIES, OM.fact_ctes(marts.FACT_COLUMNS) + [
    ("l_slice", """
      SELECT * FROM fact
      WHERE trading_date <= (SELECT MAX(trading_date) FROM fact)
        AND trading_date > (SELECT MAX(trading_date) FROM fact) - INTERVAL 90 DAY"""),
    ("l_w", "SELECT ticker, trading_date, list([" + ", ".join(
        f"CAST(COALESCE({c}, 0) AS FLOAT)" for c in S.SEQUENCE_FEATURES) + """])
        OVER (PARTITION BY ticker ORDER BY trading_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS sequence,
        [""" + ", ".join(f"CAST(COALESCE({c}, 0) AS FLOAT)" for c in S.TABULAR_FEATURES) + """] AS tabular,
        ROW_NUMBER() OVER (PARTITION BY ticker ORDER BY trading_date DESC) AS rn FROM l_slice"""),
], "SELECT ticker, sequence, tabular FROM l_w WHERE rn = 1 AND len(sequence) = 30"))
def json_roundtrip(spark: SparkSession, d: str):
    """SNK11 + SNK12: latest windows written as JSON lines and parsed back (blank
    and malformed lines in the same stream are skipped)."""
    fact = build_model_frame(spark, d, recent=True)
    windows = S.latest_window(lookback_slice(fact, "trading_date", days=90, dates=P.stock_price_eod(spark, d)))
    lines = L.payloads(windows)
    # every ticker's line travels with a blank and a truncated (malformed) line
    noise = windows.select(F.lit("").alias("value")).unionByName(
        windows.select(F.concat(F.lit('{"ticker": "'), F.col("ticker")).alias("value")))
    parsed = lines.unionByName(noise).where(F.trim("value") != "").select(
        F.from_json("value", "ticker string, sequence array<array<float>>, tabular array<float>",
                    {"mode": "PERMISSIVE"}).alias("p"))
    return parsed.where(F.col("p.ticker").isNotNull()).select("p.ticker", "p.sequence", "p.tabular")


@register("normalise_foreign", with_proxies(["foreign_flow"], [], """
    SELECT ticker, CAST(trading_date AS VARCHAR) AS trading_date, buy_vol, sell_vol, buy_val, sell_val, net_val
    FROM foreign_flow"""))
def normalise_foreign(spark: SparkSession, d: str):
    """NRM3: vendor foreign-flow quotes (ISO timestamps, camelCase fields) -> bronze rows."""
    f = P.foreign_trading(spark, d)
    raw = f.select(
        F.col("ticker").alias("symbol"),
        F.concat(F.col("trading_date").cast("string"), F.lit("T00:00:00Z")).alias("date"),
        F.col("buy_vol").alias("buyForeignQuantity"), F.col("sell_vol").alias("sellForeignQuantity"),
        F.col("buy_val").alias("buyForeignValue"), F.col("sell_val").alias("sellForeignValue"),
    )
    return N.norm_foreign_flow(raw, "symbol")

"""Feature queries over the proxy market tables (marts, windows, labels)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.operators import windows as W
from tidemark.plans import marts
from tidemark.plans import oracle_marts as OM
from tidemark.plans.catalog import register
from tidemark.plans.oracle import with_proxies
from tidemark.sources import proxies as P


def _sel(name: str) -> str:
    return f"SELECT * FROM {name}"


# --------------------------------------------------------------------------
# momentum: W1-W9, J2
# --------------------------------------------------------------------------
@register("momentum_mart", with_proxies(["price", "idx"], OM.MOMENTUM, _sel("momentum")))
def momentum_mart(spark: SparkSession, d: str):
    return marts.momentum_mart(P.stock_price_eod(spark, d), P.index_price_eod(spark, d))


@register("index_returns", with_proxies(["idx"], OM.MOMENTUM[:2], """
    SELECT 'VNINDEX' AS index_name, r.trading_date, r.r AS index_daily_return, m.index_return_1m
    FROM m_idx_ret r JOIN m_idx_1m m ON r.trading_date = m.trading_date"""))
def index_returns(spark: SparkSession, d: str):
    """Index daily return and its 20-row mean, window partitioned by index name."""
    return marts.index_return_1m(P.index_price_eod(spark, d, once=True))


_IND_SQL = with_proxies(["price"], OM.ema_sql() + [
    ("i_d", """
      SELECT ticker, trading_date, close_cents,
             close_cents * 100 - LAG(close_cents * 100) OVER (PARTITION BY ticker ORDER BY trading_date) AS delta
      FROM price"""),
    ("i_f", """
      SELECT ticker, trading_date,
             CASE WHEN COUNT(close_cents) OVER w20 >= 20 THEN AVG(close_cents * 100) OVER w20 / 10000 END AS sma_20,
             CASE WHEN COUNT(close_cents) OVER w50 >= 50 THEN AVG(close_cents * 100) OVER w50 / 10000 END AS sma_50,
             COUNT(*) OVER w14 AS n14,
             SUM(CASE WHEN delta > 0 THEN delta ELSE 0 END) OVER w14 AS g,
             SUM(CASE WHEN delta < 0 THEN -delta ELSE 0 END) OVER w14 AS l
      FROM i_d
      WINDOW w20 AS (PARTITION BY ticker ORDER BY trading_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
             w50 AS (PARTITION BY ticker ORDER BY trading_date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
             w14 AS (PARTITION BY ticker ORDER BY trading_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)"""),
], """
    SELECT f.ticker, f.trading_date, f.sma_20, f.sma_50,
           CASE WHEN n14 >= 14 AND l = 0 AND g > 0 THEN 100.0
                WHEN n14 >= 14 AND l > 0 THEN 100 - 100 / (1 + CAST(g AS DOUBLE) / CAST(l AS DOUBLE)) END AS rsi_14,
           e.ef - e.es AS macd
    FROM i_f f LEFT JOIN e_rec e ON f.ticker = e.ticker AND f.trading_date = e.trading_date""")


@register("price_indicators", _IND_SQL)
def price_indicators(spark: SparkSession, d: str):
    """W5 full-window SMA, W10 RSI-14, W11 EMA/MACD (scan over blocks of days)."""
    return marts.price_indicators(P.stock_price_eod(spark, d))



def _pair_corr_sql(x: str, y: str, frame: str, min_pairs: int) -> str:
    """Exact pair-filtered Pearson (mirrors windows.rolling_corr)."""
    xe = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN CAST({x} AS HUGEINT) END"
    ye = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN CAST({y} AS HUGEINT) END"
    k = f"CAST(COUNT(CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN 1 END) OVER {frame} AS HUGEINT)"
    sx, sy = f"SUM({xe}) OVER {frame}", f"SUM({ye}) OVER {frame}"
    vx = f"CAST({k} * SUM({xe} * {xe}) OVER {frame} - {sx} * {sx} AS DOUBLE)"
    vy = f"CAST({k} * SUM({ye} * {ye}) OVER {frame} - {sy} * {sy} AS DOUBLE)"
    cov = f"CAST({k} * SUM({xe} * {ye}) OVER {frame} - {sx} * {sy} AS DOUBLE)"
    return f"CASE WHEN {k} >= {min_pairs} AND {vx} * {vy} > 0 THEN {cov} / SQRT({vx} * {vy}) END"


# --------------------------------------------------------------------------
# flows: W12-W15, J7
# --------------------------------------------------------------------------
@register("flows_mart", with_proxies(["foreign_flow", "prop_flow"], OM.FLOWS, _sel("flows")))
def flows_mart(spark: SparkSession, d: str):
    return marts.flows_mart(P.foreign_trading(spark, d), P.proprietary_trading(spark, d))


@register("prop_foreign_corr_plain", with_proxies(["foreign_flow", "prop_flow"], [("own_pairs", """
    SELECT p.ticker, p.trading_date, CAST(p.net_val AS HUGEINT) AS x, CAST(f.net_val AS HUGEINT) AS y FROM prop_flow p LEFT JOIN foreign_flow f USING (ticker, trading_date)""")], """
    SELECT ticker, trading_date, """ + _pair_corr_sql("x", "y", "w", 2) + """ AS corr_10d
    FROM own_pairs WINDOW w AS (PARTITION BY ticker ORDER BY trading_date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"""))
def prop_foreign_corr_plain(spark: SparkSession, d: str):
    """W15 clean variant: Pearson over complete pairs only."""
    prop, foreign = P.proprietary_trading(spark, d), P.foreign_trading(spark, d)
    pj = prop.select("ticker", "trading_date", F.col("net_val").alias("x")).join(
        foreign.select("ticker", "trading_date", F.col("net_val").alias("y")), ["ticker", "trading_date"], "left")
    w = W.series_window("ticker", "trading_date")
    return W.with_rolling_corr(pj, "x", "y", w, 10, "corr_10d").select("ticker", "trading_date", "corr_10d")


# --------------------------------------------------------------------------
# macro: AGG3, AGG6, J2, W16, W17, F9-F11 (+ J3 forward fill)
# --------------------------------------------------------------------------
_MACRO_PX = ["rates", "fx", "commodities", "macro"]


def _macro_inputs(spark: SparkSession, d: str):
    return (P.interest_rates(spark, d), P.exchange_rates(spark, d), P.macro_indicators(spark, d),
            P.commodities_price(spark, d))


@register("macro_mart", with_proxies(_MACRO_PX, OM.MACRO, _sel("macro_mart")))
def macro_mart(spark: SparkSession, d: str):
    return marts.macro_mart(*_macro_inputs(spark, d))


@register("macro_ffill", with_proxies(_MACRO_PX, OM.MACRO_FFILL, _sel("macro_mart")))
def macro_ffill(spark: SparkSession, d: str):
    """D4 fixed: monthly macro values carried forward to each day by a backward as-of join."""
    return marts.macro_mart(*_macro_inputs(spark, d), macro_fill="ffill")


# --------------------------------------------------------------------------
# sentiment: AGG4, AGG5, W18, SO1, J9, F12, F13
# --------------------------------------------------------------------------
@register("sentiment_mart", with_proxies(["news", "analyst", "corp_events"], OM.SENTIMENT, _sel("sentiment")))
def sentiment_mart(spark: SparkSession, d: str):
    return marts.sentiment_mart(P.news_articles(spark, d), P.analyst_reports(spark, d),
                                P.corporate_events(spark, d))


@register("event_counts", with_proxies(["corp_events"], OM.SENTIMENT[3:4], """
    SELECT ticker, date, event_count, CAST(dividend_event_count AS BIGINT) AS dividend_event_count FROM s_ev"""))
def event_counts(spark: SparkSession, d: str):
    return marts.event_counts(P.corporate_events(spark, d))


# --------------------------------------------------------------------------
# fundamentals: W19, AGG2, J4, F1-F8 and the as-of variant
# --------------------------------------------------------------------------
def _statements(spark: SparkSession, d: str):
    return P.income_statement(spark, d), P.balance_sheet(spark, d), P.cashflow_statement(spark, d)


@register("fundamentals_mart", with_proxies(["price", "income", "balance", "cashflow", "profile"],
                                            OM.FUNDAMENTALS, _sel("fundamentals")))
def fundamentals_mart(spark: SparkSession, d: str):
    return marts.fundamentals_mart(P.stock_price_eod(spark, d), *_statements(spark, d), P.company_profile(spark, d))


@register("fundamentals_asof", with_proxies(["price", "income", "balance", "cashflow", "profile"],
                                            OM.FUNDAMENTALS_ASOF, _sel("fundamentals_asof")))
def fundamentals_asof(spark: SparkSession, d: str):
    return marts.fundamentals_asof(P.stock_price_eod(spark, d), *_statements(spark, d), P.company_profile(spark, d))


@register("latest_quarter", with_proxies(["income"], OM.FUNDAMENTALS[:1], """
    SELECT ticker, revenue, net_profit_after_tax, revenue_yoy, net_profit_yoy FROM u_inc"""))
def latest_quarter(spark: SparkSession, d: str):
    """AGG2 + W19: newest quarter per ticker with its 4-quarter-lag values."""
    inc = marts.with_yoy(P.income_statement(spark, d),
                         {"revenue": "revenue_yoy", "net_profit_after_tax": "net_profit_yoy"})
    return marts.latest_quarter(inc).select("ticker", "revenue", "net_profit_after_tax", "revenue_yoy",
                                            "net_profit_yoy")


# --------------------------------------------------------------------------
# labels and the wide fact table
# --------------------------------------------------------------------------
@register("forward_labels", with_proxies(["price"], OM.LABELS, _sel("labels")))
def forward_labels(spark: SparkSession, d: str):
    return marts.forward_labels(P.stock_price_eod(spark, d, once=True), with_drawdown=True)


def build_fact(spark: SparkSession, d: str):
    prices = P.stock_price_eod(spark, d)
    mom = marts.momentum_mart(prices, P.index_price_eod(spark, d), labels=True)
    fun = marts.fundamentals_mart(prices, *_statements(spark, d), P.company_profile(spark, d))
    snt = marts.sentiment_mart(P.news_articles(spark, d), P.analyst_reports(spark, d), P.corporate_events(spark, d))
    mac = marts.macro_mart(*_macro_inputs(spark, d))
    flw = marts.flows_mart(P.foreign_trading(spark, d), P.proprietary_trading(spark, d))
    return marts.fact_table(prices, mom, fun, snt, mac, flw)


_FACT_SQL = with_proxies(OM.FACT_PROXIES, OM.fact_ctes(marts.FACT_COLUMNS), _sel("fact"))


@register("fact_table", _FACT_SQL)
def fact_table(spark: SparkSession, d: str):
    """J1 + F18: the wide feature/label table (flagship)."""
    return build_fact(spark, d)


@register("relative_strength_20d", with_proxies(["price", "idx"], [], """
    SELECT p.ticker, p.trading_date, p.pm AS price_momentum_1m, i.im AS index_return_1m,
           p.pm - i.im AS relative_strength_20d
    FROM (SELECT ticker, trading_date,
                 CASE WHEN LAG(close, 20) OVER w > 0 THEN close / LAG(close, 20) OVER w - 1 END AS pm
          FROM price WINDOW w AS (PARTITION BY ticker ORDER BY trading_date)) p
    LEFT JOIN (SELECT trading_date,
                      CASE WHEN LAG(close, 20) OVER (ORDER BY trading_date) > 0
                           THEN close / LAG(close, 20) OVER (ORDER BY trading_date) - 1 END AS im
               FROM idx) i ON p.trading_date = i.trading_date"""))
def relative_strength_20d(spark: SparkSession, d: str):
    """W9 builder variant: 20-row stock momentum minus 20-row index momentum."""
    return marts.relative_strength_ratio(P.stock_price_eod(spark, d), P.index_price_eod(spark, d))


@register("flows_builder", with_proxies(["price", "foreign_flow", "prop_flow"], [("fb", """
    SELECT p.ticker, p.trading_date, p.close_cents * p.volume AS traded, f.buy_val, f.net_val AS fnet,
           q.net_val AS pnet, COALESCE(f.net_val, 0) AS fnet0
    FROM price p
    LEFT JOIN foreign_flow f ON p.ticker = f.ticker AND p.trading_date = f.trading_date
    LEFT JOIN prop_flow q ON p.ticker = q.ticker AND p.trading_date = q.trading_date""")], """
    SELECT ticker, trading_date,
           CASE WHEN COUNT(buy_val) OVER w10 = 10 AND SUM(traded) OVER w10 <> 0
                THEN CAST(SUM(buy_val) OVER w10 AS DOUBLE) / CAST(SUM(traded) OVER w10 AS DOUBLE) END
             AS foreign_buy_ratio_10d,
           CASE WHEN COUNT(*) OVER w20 = 20 THEN AVG(fnet0) OVER w20 END AS net_foreign_flow_momentum_1m,
           CASE WHEN COUNT(pnet) OVER w5 = 5 THEN CAST(SUM(pnet) OVER w5 AS BIGINT) END AS prop_trading_net_val_5d,
           """ + _pair_corr_sql("pnet", "fnet0", "w10", 10) + """ AS prop_vs_foreign_correlation_10d
    FROM fb
    WINDOW w5 AS (PARTITION BY ticker ORDER BY trading_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
           w10 AS (PARTITION BY ticker ORDER BY trading_date ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
           w20 AS (PARTITION BY ticker ORDER BY trading_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""))
def flows_builder(spark: SparkSession, d: str):
    """The offline builder's flow features on price rows."""
    return marts.flows_builder(P.stock_price_eod(spark, d), P.foreign_trading(spark, d),
                               P.proprietary_trading(spark, d), price="close_cents")  # flows are in cents


@register("event_props", """
    SELECT event_type, COUNT(*) AS n_events,
           CAST(SUM(TRY_CAST(json_extract(props, '$.k') AS INTEGER)) AS BIGINT) AS sum_k
    FROM events GROUP BY event_type""")
def event_props(spark: SparkSession, d: str):
    """SRC5: JSON text kept as VARIANT and queried by path."""
    from tidemark.functions.columns import variant_col, variant_field
    from tidemark.sources.tables import read_table

    e = read_table(spark, d, "events").select("event_type", variant_col("props").alias("v"))
    return e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"),
                                       F.sum(variant_field("v", "$.k", "int")).alias("sum_k"))


#: Rows per ticker that the newest 90 days can depend on: 90 of their own, a 90-row lag, windows up to 50 rows.
RECENT_ROWS = 260


def newest_rows(df, rows: int = RECENT_ROWS):
    """The newest rows of each ticker; a row limit per key, so each task keeps no more than these."""
    from pyspark.sql import Window

    newest = Window.partitionBy("ticker").orderBy(F.col("trading_date").desc())
    return df.withColumn("__newest", F.row_number().over(newest)).where(F.col("__newest") <= rows).drop("__newest")


def build_model_frame(spark: SparkSession, d: str, recent: bool = False):
    """The fact table's rows with only the columns the model reads (sequence and
    tabular features, labels): the price rows with momentum and labels left-joined
    to the fundamentals and flow marts.  Identical values to selecting those columns
    from ``build_fact`` -- every mart is unique on (ticker, date) -- without the
    sentiment and macro joins that Catalyst cannot drop on its own.  ``recent`` cuts
    prices and flows to the rows that the newest 90 days depend on, before any mart."""
    from tidemark.operators.samples import SEQUENCE_FEATURES, TABULAR_FEATURES

    cut = newest_rows if recent else (lambda df: df)
    prices = cut(P.stock_price_eod(spark, d))
    keys = ["ticker", "trading_date"]
    mom = marts.momentum_mart(prices, P.index_price_eod(spark, d), labels=True)
    fun = marts.fundamentals_mart(prices, *_statements(spark, d), P.company_profile(spark, d))
    flw = marts.flows_mart(cut(P.foreign_trading(spark, d)), cut(P.proprietary_trading(spark, d)))
    out = mom.join(fun, keys, "left").join(flw, keys, "left")
    return out.select(*keys, *SEQUENCE_FEATURES, *TABULAR_FEATURES, *marts.LABEL_COLUMNS)

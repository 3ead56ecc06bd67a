"""Gold marts: momentum, flows, macro, sentiment, fundamentals, fact.

Each mart is a function of silver DataFrames -> DataFrame.  Decimals become double on
entry; moving averages run on exact integer ticks so results do not depend on
summation order; ``typed`` gives the declared types for writing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import windows as W
from tidemark.session import small_side

TICKER_DATE = ("ticker", "trading_date")


TICKS = 10_000  # prices are decimal(38,4) in silver: an exact integer of the last place


def plain(df: DataFrame) -> DataFrame:
    """Decimal inputs as double: ratios and deviations are computed in double and
    cast to their declared type only at the end (``typed``)."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


def ticks(price: str) -> Column:
    return (F.col(price).cast("decimal(38,4)") * TICKS).cast("bigint")


# Declared types of mart columns; a column that isn't listed is decimal(18,6).
_AMOUNTS = ("moving_average_20d", "moving_average_50d", "moving_average_200d", "net_foreign_flow_1m", "prop_trading_net_val_5d",
            "fed_rate", "treasury_10y", "treasury_5y", "real_interest_rate", "usd_vnd_rate", "cpi_value", "policy_rate",
            "brent_crude_price", "wti_price", "gold_price", "steel_hrc_price", "gasoline_singapore_price",
            "baltic_dirty_tanker_index", "crack_spread_proxy", "pe_ratio", "pb_ratio", "free_cash_flow",
            "daily_news_sentiment_score", "sentiment_momentum_7d", "news_velocity", "avg_analyst_target_price")
_KEPT = {"ticker": "string", "trading_date": "date", "date": "date", "label_is_uptrend_30d": "smallint",
         **{c: "int" for c in ("news_count", "analyst_report_count", "analyst_buy_count", "corporate_event_count",
                               "dividend_event_count")},
         **{c: "decimal(38,4)" for c in _AMOUNTS}}


def declared(columns: Sequence[str]) -> T.StructType:
    """The declared schema of a mart with these columns."""
    return T.StructType([T.StructField(c, T._parse_datatype_string(_KEPT.get(c, "decimal(18,6)"))) for c in columns])


def typed(mart: DataFrame) -> DataFrame:
    """A mart's rows in its declared types, ready to be written."""
    return mart.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared(mart.columns).fields])


# -- momentum (W1-W9, J2) ------------------------------------------------------
def index_return_1m(index: DataFrame, names: Sequence[str] = ("VNINDEX",), n: int = 20) -> DataFrame:
    """Daily return of each named index and its n-row mean.  Partitioned by
    index name (no single-partition window)."""
    w = W.series_window("index_name", "trading_date")
    ix = plain(index.where(F.col("index_name").isin(list(names))))
    ret = ix.select("index_name", "trading_date", W.simple_return("close", w).alias("index_daily_return"))
    return ret.select(
        "index_name", "trading_date", "index_daily_return",
        W.rolling_mean("index_daily_return", n, w).alias("index_return_1m"),
    )


def _moving_averages(df: DataFrame, w, price: str, windows: Sequence[int],
                     names: Sequence[str], min_periods: Sequence[int]) -> DataFrame:
    """Trailing means on exact integer ticks, by running totals (O(rows))."""
    df = df.withColumn("__ticks", ticks(price))
    for n, name, mp in zip(windows, names, min_periods):
        df = W.rolling_mean_exact(df, "__ticks", n, w, name, min_periods=mp, scale=TICKS)
    return df.drop("__ticks")


def momentum_features(prices: DataFrame, lag_1m: int = 30, lag_3m: int = 90,
                      ma_windows: Sequence[int] = (20, 50, 200), vol_n: int = 30, ret_n: int = 20,
                      price: str = "adjusted_close", labels: bool = False) -> DataFrame:
    """Per-ticker price features, and the forward labels if asked for, on one window
    spec (one Exchange + Sort)."""
    w = W.series_window("ticker", "trading_date")
    base = plain(prices.select("ticker", "trading_date", price)).select(
        "*", *(label_columns(price, w) if labels else ()),
        W.simple_return(price, w).alias("daily_return"),
        W.momentum(price, lag_1m, w).alias("price_momentum_1m"),
        W.momentum(price, lag_3m, w).alias("price_momentum_3m"),
    )
    base = _moving_averages(base, w, price, ma_windows, [f"moving_average_{n}d" for n in ma_windows],
                            [1] * len(ma_windows))
    return base.select(
        "*",
        W.rolling_std("daily_return", vol_n, w).alias("volatility_30d"),
        W.rolling_mean("daily_return", ret_n, w).alias("avg_return_1m"),
    ).drop(price)


def momentum_mart(prices: DataFrame, index: DataFrame, index_names: Sequence[str] = ("VNINDEX",),
                  lag_1m: int = 30, lag_3m: int = 90, labels: bool = False) -> DataFrame:
    """MART momentum: stock features + relative strength vs the index (J2).  ``labels``
    adds the forward labels, which share the window: no join brings them together."""
    feats = momentum_features(prices, lag_1m=lag_1m, lag_3m=lag_3m, labels=labels)
    ix = small_side(index_return_1m(index, index_names).select("trading_date", "index_return_1m"))
    joined = feats.join(ix, "trading_date", "left")
    return joined.select(
        "ticker", "trading_date", "price_momentum_1m", "price_momentum_3m", "volatility_30d",
        (F.col("avg_return_1m") - F.col("index_return_1m")).alias("relative_strength_vs_vnindex"),
        "moving_average_20d", "moving_average_50d", "moving_average_200d", *(LABEL_COLUMNS if labels else ()),
    )


# -- flows (W12-W15, J7) -------------------------------------------------------
def flows_mart(foreign: DataFrame, prop: DataFrame, ratio_n: int = 10, flow_n: int = 20,
               prop_n: int = 5, corr_n: int = 10) -> DataFrame:
    """MART flows at (ticker, trading_date); the foreign side drives the rows."""
    w = W.series_window("ticker", "trading_date")
    ff = plain(foreign).select(
        "ticker", "trading_date", "net_val",
        W.buy_ratio("buy_val", "sell_val", w, ratio_n).alias("foreign_buy_ratio_10d"),
    )
    ff = W.flow_momentum(ff, "net_val", w, flow_n, out="net_foreign_flow_momentum_1m",
                         sum_col="net_foreign_flow_1m")
    pf = plain(prop).select("ticker", "trading_date",
                     W.rolling_sum("net_val", prop_n, w).alias("prop_trading_net_val_5d"))
    # correlation rows: every prop day, foreign value when that day has one
    pj = prop.select("ticker", "trading_date", F.col("net_val").alias("x")).join(
        foreign.select("ticker", "trading_date", F.col("net_val").alias("y")), list(TICKER_DATE), "left"
    )
    pc = W.with_rolling_corr(pj, "x", "y", w, corr_n, "prop_vs_foreign_correlation_10d", mode="parity").select(
        "ticker", "trading_date", "prop_vs_foreign_correlation_10d")
    out = ff.join(pf, list(TICKER_DATE), "left").join(pc, list(TICKER_DATE), "left")
    return out.select(
        "ticker", "trading_date", "foreign_buy_ratio_10d", "net_foreign_flow_1m",
        "net_foreign_flow_momentum_1m", "prop_trading_net_val_5d", "prop_vs_foreign_correlation_10d",
    )


# -- macro (AGG3, AGG6, J2, W16, W17, F9-F11) -----------------------------------
# Series names the macro mart pivots on.  Both the spelling the
# mart expects and the one the feeds write are accepted.
FED_NAMES = ("^IRX", "us_fed_funds_rate")
T10_NAMES = ("^TNX", "us_10y_treasury")
T5_NAMES = ("^FVX", "us_5y_treasury")
FX_PAIRS = ("USDT/VND", "USD/VND")
CPI_NAMES = ("CPI", "vn_cpi_inflation")
POLICY_NAMES = ("INTEREST_RATE",)
BRENT = "Brent Crude"


def _max_if(cond: Column, value: str) -> Column:
    return F.max(F.when(cond, F.col(value)))


def rates_pivot(rates: DataFrame, fed=FED_NAMES, t10=T10_NAMES, t5=T5_NAMES) -> DataFrame:
    rt = F.col("rate_type")
    return rates.groupBy("date").agg(
        _max_if(rt.isin(list(fed)), "rate_value").alias("fed_rate"),
        _max_if(rt.isin(list(t10)), "rate_value").alias("treasury_10y"),
        _max_if(rt.isin(list(t5)), "rate_value").alias("treasury_5y"),
    )


def fx_volatility(fx: DataFrame, pairs=FX_PAIRS, n: int = 30) -> DataFrame:
    """USD/VND level and the n-row volatility of its daily return (one series,
    keyed by a canonical pair name so the window is partitioned)."""
    one = fx.where(F.col("pair").isin(list(pairs))).groupBy("date").agg(
        F.max("exchange_rate").alias("usd_vnd_rate")
    ).withColumn("series", F.lit(pairs[-1]))
    w = W.series_window("series", "date")
    ret = one.select("series", "date", "usd_vnd_rate", W.simple_return("usd_vnd_rate", w).alias("fx_return"))
    return ret.select("date", "usd_vnd_rate",
                      W.rolling_std("fx_return", n, w).alias("exchange_rate_volatility_30d"))


def macro_pivot(macro: DataFrame, cpi=CPI_NAMES, policy=POLICY_NAMES) -> DataFrame:
    name = F.col("indicator_name")
    return macro.groupBy(F.col("report_date").alias("date")).agg(
        _max_if(name.isin(list(cpi)), "value").alias("cpi_value"),
        _max_if(name.isin(list(policy)), "value").alias("policy_rate"),
    )


def series_momentum(df: DataFrame, name_col: str, name: str, value: str, n: int = 30,
                    out: str = "brent_price_momentum_1m") -> DataFrame:
    """value / lag(value, n) - 1 for one named series (partitioned by the name)."""
    w = W.series_window(name_col, "date")
    s = df.where(F.col(name_col) == name)
    return s.select("date", W.momentum(value, n, w).alias(out))


def commodities_pivot(comm: DataFrame) -> DataFrame:
    n = F.col("commodity_name")
    return comm.groupBy("date").agg(
        _max_if(n == BRENT, "price").alias("brent_crude_price"),
        _max_if(n == "WTI", "price").alias("wti_price"),
        _max_if(n == "Gold", "price").alias("gold_price"),
        _max_if(n == "Steel HRC", "price").alias("steel_hrc_price"),
        _max_if(n.like("%Gasoline%") & n.like("%Singapore%"), "price").alias("gasoline_singapore_price"),
        _max_if(n.like("%Baltic%") & n.like("%Dirty%"), "price").alias("baltic_dirty_tanker_index"),
    )


MACRO_COLUMNS = (
    "fed_rate", "treasury_10y", "treasury_5y", "real_interest_rate", "usd_vnd_rate",
    "exchange_rate_volatility_30d", "cpi_value", "policy_rate", "brent_crude_price", "wti_price",
    "gold_price", "steel_hrc_price", "gasoline_singapore_price", "baltic_dirty_tanker_index",
    "brent_price_momentum_1m", "crack_spread_proxy",
)


def macro_mart(rates: DataFrame, fx: DataFrame, macro: DataFrame, comm: DataFrame,
               macro_fill: str = "exact") -> DataFrame:
    """MART macro at (date).  Spine = distinct commodity dates (AGG6).

    ``macro_fill='exact'`` joins monthly macro values on the exact date (the
    reference's behaviour, D4); ``'ffill'`` carries the latest report forward
    with a backward as-of join (J3)."""
    from tidemark.operators.asof import asof_backward

    rates, fx, macro, comm = (plain(x) for x in (rates, fx, macro, comm))
    spine = comm.select("date").distinct()
    ir = rates_pivot(rates)
    er = fx_volatility(fx)
    cp = commodities_pivot(comm)
    br = series_momentum(comm, "commodity_name", BRENT, "price")
    mp = macro_pivot(macro)
    if macro_fill == "ffill":
        keyed = spine.withColumn("_k", F.lit(0))
        m = asof_backward(keyed, mp.withColumn("_k", F.lit(0)), by=["_k"], left_on="date", right_on="date",
                          columns=["cpi_value", "policy_rate"]).drop("_k")
    else:
        m = spine.join(mp, "date", "left")
    out = m.join(ir, "date", "left").join(er, "date", "left").join(cp, "date", "left").join(br, "date", "left")
    both = lambda a, b: F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.col(a) - F.col(b))
    return out.select(
        "date", "fed_rate", "treasury_10y", "treasury_5y",
        both("fed_rate", "cpi_value").alias("real_interest_rate"),
        "usd_vnd_rate", "exchange_rate_volatility_30d", "cpi_value", "policy_rate",
        "brent_crude_price", "wti_price", "gold_price", "steel_hrc_price", "gasoline_singapore_price",
        "baltic_dirty_tanker_index", "brent_price_momentum_1m",
        both("gasoline_singapore_price", "brent_crude_price").alias("crack_spread_proxy"),
    )


# -- sentiment (AGG4, AGG5, W18, SO1, J9, F12, F13) ------------------------------
# Event-type patterns counted as dividends.
DIVIDEND_PATTERNS = ("%DIVIDEND%", "%CHIA_CO_TUC%")


def news_daily(news: DataFrame, vel_n: int = 30, sent_n: int = 7) -> DataFrame:
    w = W.series_window("ticker", "date")
    daily = news.groupBy("ticker", F.col("publish_time").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("news_count")
    ).withColumn("avg_sentiment_score", F.lit(None).cast("double"))
    return daily.select(
        "ticker", "date", "news_count", "avg_sentiment_score",
        W.rolling_mean("avg_sentiment_score", sent_n, w).alias("sentiment_momentum_7d"),
        W.rolling_mean("news_count", vel_n, w).alias("avg_news_count_30d"),
    )


def analyst_daily(reports: DataFrame) -> DataFrame:
    return reports.groupBy("ticker", F.col("publish_date").alias("date")).agg(
        F.count(F.lit(1)).alias("analyst_report_count")
    )


def event_counts(events: DataFrame, patterns=DIVIDEND_PATTERNS) -> DataFrame:
    up = F.upper(F.col("event_type"))
    is_div = None
    for p in patterns:
        is_div = up.like(p) if is_div is None else (is_div | up.like(p))
    day = F.coalesce("ex_right_date", "record_date", "batch_date")
    return events.groupBy("ticker", day.alias("date")).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.sum(F.when(is_div, 1).otherwise(0)).alias("dividend_event_count"),
    )


def sentiment_mart(news: DataFrame, reports: DataFrame, events: DataFrame) -> DataFrame:
    nd = news_daily(news)
    ad = analyst_daily(reports)
    ev = event_counts(events)
    spine = nd.select("ticker", "date").union(ad.select("ticker", "date")).distinct()
    out = spine.join(nd, ["ticker", "date"], "left").join(ad, ["ticker", "date"], "left").join(
        ev, ["ticker", "date"], "left"
    )
    return out.select(
        "ticker", "date",
        F.coalesce("news_count", F.lit(0)).cast("int").alias("news_count"),
        F.col("avg_sentiment_score").alias("daily_news_sentiment_score"),
        "sentiment_momentum_7d",
        F.when(F.col("avg_news_count_30d") > 0, F.col("news_count") / F.col("avg_news_count_30d")).alias(
            "news_velocity"),
        F.coalesce("analyst_report_count", F.lit(0)).cast("int").alias("analyst_report_count"),
        F.lit(0).cast("int").alias("analyst_buy_count"),
        F.lit(None).cast("double").alias("avg_analyst_target_price"),
        F.coalesce("event_count", F.lit(0)).cast("int").alias("corporate_event_count"),
        F.coalesce("dividend_event_count", F.lit(0)).cast("int").alias("dividend_event_count"),
    )


# -- fundamentals (W19, AGG2, J4, F1-F8) -----------------------------------------
def _ratio(n: Column, d: Column, positive: bool = False) -> Column:
    return F.when(d > 0 if positive else d != 0, n / d)


def quarter_window():
    return W.series_window("ticker", ["year", "period"])


def with_yoy(df: DataFrame, cols: dict[str, str], q: int = 4) -> DataFrame:
    """Add ``lag(x, q)`` over the quarterly series for each {x: out}."""
    w = quarter_window()
    return df.select("*", *[F.lag(x, q).over(w).alias(o) for x, o in cols.items()])


def latest_quarter(df: DataFrame) -> DataFrame:
    """Newest (year, period) row per ticker (AGG2).  Planned as a
    WindowGroupLimit: at most one row per ticker leaves each task."""
    from tidemark.operators.dedupe import latest_by

    return latest_by(df, ["ticker"], [F.col("year").desc(), F.col("period").desc()])


def fundamentals_latest(income: DataFrame, balance: DataFrame, cash: DataFrame) -> DataFrame:
    """One row per ticker: the newest quarter of each statement (D7 parity)."""
    inc = latest_quarter(with_yoy(income, {"revenue": "revenue_yoy", "net_profit_after_tax": "net_profit_yoy"}))
    bal = latest_quarter(with_yoy(balance, {"total_assets": "total_assets_yoy"}))
    cf = latest_quarter(cash)
    return (
        inc.select("ticker", "revenue", "gross_profit", "operating_profit", "net_profit_after_tax",
                   "revenue_yoy", "net_profit_yoy")
        .join(bal.select("ticker", "total_assets", "current_assets", "cash", "total_liabilities",
                         "short_term_debt", "long_term_debt", "equity", "total_assets_yoy"), "ticker", "full_outer")
        .join(cf.select("ticker", "cfo", "capex"), "ticker", "full_outer")
    )


FUNDAMENTAL_COLUMNS = (
    "revenue_growth_yoy", "net_profit_growth_yoy", "gross_margin", "net_margin", "operating_margin", "roe", "roa",
    "asset_growth_yoy", "debt_to_equity", "current_ratio", "cash_to_assets", "equity_multiplier", "pe_ratio",
    "pb_ratio", "operating_cash_flow_to_net_income", "free_cash_flow", "cash_flow_to_debt",
)


def fundamentals_mart(prices: DataFrame, income: DataFrame, balance: DataFrame, cash: DataFrame,
                      profile: DataFrame) -> DataFrame:
    """MART fundamentals at (ticker, trading_date): latest snapshot on every day."""
    income, balance, cash, prices = (plain(x) for x in (income, balance, cash, prices))
    snap = fundamentals_latest(income, balance, cash).join(
        plain(profile.select("ticker", "outstanding_share")), "ticker", "left"
    )
    r = prices.select("ticker", "trading_date", "close").join(small_side(snap), "ticker", "left")
    c = F.col
    debt = c("short_term_debt") + c("long_term_debt")
    npat = c("net_profit_after_tax")
    mcap = c("close") * c("outstanding_share")
    return r.select(
        "ticker", "trading_date",
        _ratio(c("revenue"), c("revenue_yoy"), True).__sub__(1).alias("revenue_growth_yoy"),
        _ratio(npat, c("net_profit_yoy"), True).__sub__(1).alias("net_profit_growth_yoy"),
        _ratio(c("gross_profit"), c("revenue")).alias("gross_margin"),
        _ratio(npat, c("revenue")).alias("net_margin"),
        _ratio(c("operating_profit"), c("revenue")).alias("operating_margin"),
        _ratio(npat, c("equity")).alias("roe"),
        _ratio(npat, c("total_assets")).alias("roa"),
        _ratio(c("total_assets"), c("total_assets_yoy"), True).__sub__(1).alias("asset_growth_yoy"),
        _ratio(debt, c("equity")).alias("debt_to_equity"),
        _ratio(c("current_assets"), c("total_liabilities")).alias("current_ratio"),
        _ratio(c("cash"), c("total_assets")).alias("cash_to_assets"),
        _ratio(c("total_assets"), c("equity")).alias("equity_multiplier"),
        F.when((npat != 0) & c("outstanding_share").isNotNull(), mcap / npat).alias("pe_ratio"),
        F.when((c("equity") != 0) & c("outstanding_share").isNotNull(), mcap / c("equity")).alias("pb_ratio"),
        _ratio(c("cfo"), npat).alias("operating_cash_flow_to_net_income"),
        (c("cfo") - c("capex")).alias("free_cash_flow"),
        _ratio(c("cfo"), debt).alias("cash_flow_to_debt"),
    )


def fundamentals_quarterly(income: DataFrame, balance: DataFrame, cash: DataFrame,
                           annualise: bool = True) -> DataFrame:
    """Offline-builder fundamentals per (ticker, year, period): statements full-
    outer-joined (J5), report date (F14), YoY by 4-quarter lag, ratios with the
    builder's rules (x4 annualised ROE/ROA, missing debt as 0, current ratio
    over short-term debt; D11).  Division by zero gives NULL (the builder's inf
    is not carried)."""
    from tidemark.functions.dates import available_on

    keys = ["ticker", "year", "period"]
    fund = income.join(balance, keys, "full_outer").join(cash, keys, "full_outer")
    fund = fund.withColumn("report_date", available_on("year", "period"))
    w = quarter_window()
    c = F.col
    k = 4 if annualise else 1
    npat = c("net_profit_after_tax")
    debt = F.coalesce(c("short_term_debt"), F.lit(0)) + F.coalesce(c("long_term_debt"), F.lit(0))
    return fund.select(
        "ticker", "year", "period", "report_date", "net_profit_after_tax", "equity",
        _ratio(c("revenue"), F.lag("revenue", 4).over(w)).__sub__(1).alias("revenue_growth_yoy"),
        _ratio(npat, F.lag("net_profit_after_tax", 4).over(w)).__sub__(1).alias("net_profit_growth_yoy"),
        _ratio(c("total_assets"), F.lag("total_assets", 4).over(w)).__sub__(1).alias("asset_growth_yoy"),
        _ratio(c("gross_profit"), c("revenue")).alias("gross_margin"),
        _ratio(npat, c("revenue")).alias("net_margin"),
        _ratio(c("operating_profit"), c("revenue")).alias("operating_margin"),
        _ratio(npat * k, c("equity")).alias("roe"),
        _ratio(npat * k, c("total_assets")).alias("roa"),
        _ratio(debt, c("equity")).alias("debt_to_equity"),
        _ratio(c("current_assets"), c("short_term_debt")).alias("current_ratio"),
        _ratio(c("cash"), c("total_assets")).alias("cash_to_assets"),
        _ratio(c("total_assets"), c("equity")).alias("equity_multiplier"),
        _ratio(c("cfo"), npat).alias("operating_cash_flow_to_net_income"),
        (c("cfo") - F.coalesce(c("capex"), F.lit(0))).alias("free_cash_flow"),
        _ratio(c("cfo"), debt).alias("cash_flow_to_debt"),
    )


ASOF_COLUMNS = (
    "report_date", "net_profit_after_tax", "equity", "revenue_growth_yoy", "net_profit_growth_yoy",
    "gross_margin", "net_margin", "operating_margin", "roe", "roa", "asset_growth_yoy", "debt_to_equity",
    "current_ratio", "cash_to_assets", "equity_multiplier", "operating_cash_flow_to_net_income",
    "free_cash_flow", "cash_flow_to_debt",
)


def fundamentals_asof(prices: DataFrame, income: DataFrame, balance: DataFrame, cash: DataFrame,
                      profile: DataFrame) -> DataFrame:
    """No-look-ahead fundamentals: each trading day sees the newest report
    published on or before it (J3), plus valuations on that report (F7, F15)."""
    from tidemark.operators.asof import asof_backward, dedupe_right

    income, balance, cash, prices, profile = (plain(x) for x in (income, balance, cash, prices, profile))
    q = fundamentals_quarterly(income, balance, cash)
    q = dedupe_right(q, ["ticker"], "report_date", [F.col("year"), F.col("period")])
    px = prices.select("ticker", "trading_date", "close").join(
        small_side(profile.select("ticker", "outstanding_share").distinct()), "ticker", "left"
    )
    m = asof_backward(px, q, ["ticker"], "trading_date", "report_date", list(ASOF_COLUMNS))
    mcap = F.col("close") * F.col("outstanding_share")
    np4 = F.col("net_profit_after_tax") * 4
    return m.select(
        "ticker", "trading_date", *ASOF_COLUMNS, mcap.alias("market_cap"),
        _ratio(mcap, np4).alias("pe_ratio"), _ratio(mcap, F.col("equity")).alias("pb_ratio"),
    ).drop("net_profit_after_tax", "equity")


# -- labels (W20-W22) and the wide fact table (J1, F18) --------------------------
LABEL_COLUMNS = ("label_next_5d_return", "label_next_20d_return", "label_is_uptrend_30d",
                 "label_max_drawdown_next_10d")


def label_columns(price: str, w) -> list[Column]:
    return [
        W.forward_return(price, 5, w).alias("label_next_5d_return"),
        W.forward_return(price, 20, w).alias("label_next_20d_return"),
        W.uptrend_flag(price, 20, w, 0.05).alias("label_is_uptrend_30d"),
        W.forward_extreme(price, 10, w, "max").alias("label_max_drawdown_next_10d"),
    ]


def forward_labels(prices: DataFrame, price: str = "adjusted_close", with_drawdown: bool = False) -> DataFrame:
    prices = plain(prices)
    w = W.series_window("ticker", "trading_date")
    cols = label_columns(price, w)
    if with_drawdown:
        cols.append(W.forward_extreme(price, 10, w, "min").alias("label_drawdown_next_10d"))
    return prices.select("ticker", "trading_date", *cols)


MOMENTUM_COLUMNS = ("price_momentum_1m", "price_momentum_3m", "volatility_30d", "relative_strength_vs_vnindex",
                    "moving_average_20d", "moving_average_50d", "moving_average_200d")
SENTIMENT_COLUMNS = ("news_count", "daily_news_sentiment_score", "sentiment_momentum_7d", "news_velocity",
                     "analyst_report_count", "analyst_buy_count", "avg_analyst_target_price",
                     "corporate_event_count", "dividend_event_count")
FACT_MACRO_COLUMNS = tuple(c for c in MACRO_COLUMNS if c != "policy_rate")
FLOW_COLUMNS = ("foreign_buy_ratio_10d", "net_foreign_flow_1m", "net_foreign_flow_momentum_1m",
                "prop_trading_net_val_5d", "prop_vs_foreign_correlation_10d")
FACT_COLUMNS = ("ticker", "trading_date") + MOMENTUM_COLUMNS + FUNDAMENTAL_COLUMNS + SENTIMENT_COLUMNS \
    + FACT_MACRO_COLUMNS + FLOW_COLUMNS + LABEL_COLUMNS


def fact_table(prices: DataFrame, momentum: DataFrame, fundamentals: DataFrame, sentiment: DataFrame,
               macro: DataFrame, flows: DataFrame) -> DataFrame:
    """Wide feature + label table: price rows left-joined to every mart.

    The ticker-keyed marts join on (ticker, trading_date); the date-only macro
    mart (one row per calendar day, bounded) is broadcast behind a size check."""
    keys = list(TICKER_DATE)
    # labels and momentum of one price table come together (momentum_mart(labels=True))
    base = momentum if LABEL_COLUMNS[0] in momentum.columns else forward_labels(prices).join(momentum, keys, "left")
    snt = sentiment.withColumnRenamed("date", "trading_date")
    mac = small_side(macro.withColumnRenamed("date", "trading_date").select("trading_date", *FACT_MACRO_COLUMNS))
    out = (
        base.join(fundamentals, keys, "left")
        .join(snt, keys, "left")
        .join(mac, "trading_date", "left")
        .join(flows, keys, "left")
    )
    return out.select(*FACT_COLUMNS)


# -- offline-builder price indicators (W5, W10, W11) ------------------------------
def price_indicators(prices: DataFrame, price: str = "close") -> DataFrame:
    """sma_20 / sma_50 with the full-window rule, RSI-14 and MACD(12, 26)."""
    from tidemark.operators.recursive import ema_features

    w = W.series_window("ticker", "trading_date")
    own = plain(prices.select("ticker", "trading_date", price))
    feats = _moving_averages(own, w, price, (20, 50), ("sma_20", "sma_50"), (20, 50))
    feats = feats.select("ticker", "trading_date", price, "sma_20", "sma_50", W.rsi(ticks(price), w, 14).alias("rsi_14"))
    out = ema_features(feats, "ticker", "trading_date", price, keep=("sma_20", "sma_50", "rsi_14"))
    return out.select("ticker", "trading_date", "sma_20", "sma_50", "rsi_14", "macd")


# -- offline-builder variants (W9 price-ratio relative strength, D12 flows) -------
def relative_strength_ratio(prices: DataFrame, index: DataFrame, n: int = 20, index_name: str = "VNINDEX",
                            price: str = "close") -> DataFrame:
    """W9 builder variant: n-row price momentum of the stock minus the index's."""
    w = W.series_window("ticker", "trading_date")
    wi = W.series_window("index_name", "trading_date")
    ix = index.where(F.col("index_name") == index_name).select(
        "trading_date", W.momentum("close", n, wi).alias("index_return_1m"))
    st = prices.select("ticker", "trading_date", W.momentum(price, n, w).alias("price_momentum_1m"))
    out = st.join(small_side(ix), "trading_date", "left")
    return out.select("ticker", "trading_date", "price_momentum_1m", "index_return_1m",
                      (F.col("price_momentum_1m") - F.col("index_return_1m")).alias("relative_strength_20d"))


def flows_builder(prices: DataFrame, foreign: DataFrame, prop: DataFrame, price: str = "close") -> DataFrame:
    """D12 builder variant on price rows: buy ratio over traded value (close x
    volume), 20-row mean of net foreign value (missing days = 0), 5-row prop sum
    and 10-row Pearson correlation, each NULL until its window is full."""
    keys = list(TICKER_DATE)
    w = W.series_window("ticker", "trading_date")
    base = (prices.select("ticker", "trading_date", (F.col(price) * F.col("volume")).alias("traded"))
            .join(foreign.select("ticker", "trading_date", "buy_val", F.col("net_val").alias("fnet")), keys, "left")
            .join(prop.select("ticker", "trading_date", F.col("net_val").alias("pnet")), keys, "left")
            .withColumn("fnet0", F.coalesce("fnet", F.lit(0).cast("bigint"))))
    f10, f20, f5 = W.trailing(w, 10), W.trailing(w, 20), W.trailing(w, 5)
    base = W.with_rolling_corr(base, "pnet", "fnet0", w, 10, "prop_vs_foreign_correlation_10d", min_pairs=10)
    return base.select(
        "ticker", "trading_date",
        F.when((F.count("buy_val").over(f10) == 10) & (F.sum("traded").over(f10) != 0),
               F.sum("buy_val").over(f10) / F.sum("traded").over(f10)).alias("foreign_buy_ratio_10d"),
        F.when(F.count(F.lit(1)).over(f20) == 20, F.avg("fnet0").over(f20)).alias("net_foreign_flow_momentum_1m"),
        F.when(F.count("pnet").over(f5) == 5, F.sum("pnet").over(f5)).alias("prop_trading_net_val_5d"),
        "prop_vs_foreign_correlation_10d",
    )

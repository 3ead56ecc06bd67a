"""One query per silver feed: proxy -> dirty bronze text, two loads -> typed silver.

Every feed goes through the same steps: its proxy rows are rendered as text, number
columns get vendor null tokens on some keys, and a second load re-delivers a third of
the keys with a corrected first number.  ``to_silver`` must keep the newest load per
key and guard every cast.  Decimals are returned as double for comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.silver import to_silver
from tidemark.plans import marts
from tidemark.plans import oracle_marts as OM
from tidemark.plans.catalog import register
from tidemark.plans.oracle import with_proxies
from tidemark.schemas import NULL_TOKENS, feed
from tidemark.sources import bronze_proxies as B
from tidemark.sources import proxies as P

_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)
_DIRT = ("NaN", "", "None", "<NA>")  # tokens that vendors send for a missing number


@dataclass(frozen=True)
class Source:
    """A feed's proxy, the oracle's name for it, the columns both have, and a number of each key."""

    proxy: Callable[[SparkSession, str], DataFrame]
    cte: str
    columns: tuple[str, ...]
    spark_number: Column | Callable[[], Column]
    sql_number: str


def _day(c: str) -> dict:
    return {"spark_number": lambda: F.dayofmonth(c), "sql_number": f"day({c})"}


def _quarter() -> dict:
    return {"spark_number": lambda: F.col("year") * 4 + F.substring("period", 2, 1).cast("int"),
            "sql_number": "(year * 4 + CAST(substr(period, 2, 1) AS INTEGER))"}


def _id(c: str) -> dict:
    return {"spark_number": lambda: F.col(c).cast("bigint"), "sql_number": f"CAST({c} AS BIGINT)"}


#: Averages and scaled sums: cut to four places before they become text, the same way in any engine.
FRACTIONS = ("close", "rate_value", "exchange_rate", "price", "value")
_STATEMENT = ("ticker", "period", "year")
SOURCES = {
    "index_price_eod": Source(P.index_price_eod, "idx", ("index_name", "trading_date", "close"), **_day("trading_date")),
    "foreign_trading": Source(P.foreign_trading, "foreign_flow", ("ticker", "trading_date", "buy_vol", "sell_vol", "buy_val", "sell_val", "net_val"),
                              **_day("trading_date")),
    "proprietary_trading": Source(P.proprietary_trading, "prop_flow", ("ticker", "trading_date", "net_val"), **_day("trading_date")),
    "balance_sheet": Source(P.balance_sheet, "balance", (*_STATEMENT, "total_assets", "current_assets", "cash", "inventory", "total_liabilities",
                                                         "short_term_debt", "long_term_debt", "equity"), **_quarter()),
    "income_statement": Source(P.income_statement, "income", (*_STATEMENT, "revenue", "cogs", "gross_profit", "operating_expenses", "operating_profit",
                                                              "financial_income", "financial_expenses", "net_profit_after_tax"), **_quarter()),
    "cashflow_statement": Source(P.cashflow_statement, "cashflow", (*_STATEMENT, "cfo", "cfi", "cff", "net_cash_flow", "capex"), **_quarter()),
    "company_profile": Source(P.company_profile, "profile", ("ticker", "industry", "outstanding_share"),
                              spark_number=lambda: F.length("industry"), sql_number="length(industry)"),
    "macro_indicators": Source(P.macro_indicators, "macro", ("indicator_name", "report_date", "value"),
                               spark_number=lambda: F.month("report_date"), sql_number="month(report_date)"),
    "interest_rates": Source(P.interest_rates, "rates", ("rate_type", "date", "rate_value"), **_day("date")),
    "exchange_rates": Source(P.exchange_rates, "fx", ("pair", "date", "exchange_rate"), **_day("date")),
    "commodities_price": Source(P.commodities_price, "commodities", ("commodity_name", "date", "price"), **_day("date")),
    "news_articles": Source(P.news_articles, "news", ("article_id", "ticker", "publish_time"), **_id("article_id")),
    "analyst_reports": Source(P.analyst_reports, "analyst", ("report_id", "ticker", "publish_date"), **_id("report_id")),
}


def _numbers(name: str) -> list[str]:
    kinds = dict(feed(name).columns)
    return [c for c in SOURCES[name].columns if kinds[c] == "N"]


def bronze(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Two all-text loads of a feed with lineage columns."""
    src, f = SOURCES[name], feed(name)
    numbers, at = _numbers(name), src.spark_number()

    def load(rows: DataFrame, correction: int, path: str, loaded_at: str, part: str) -> DataFrame:
        cols = []
        for c in f.bronze_columns:
            if c not in src.columns:
                cols.append(F.lit(None).cast("string").alias(c))
            elif c in numbers:
                i = numbers.index(c)
                own = F.floor(F.col(c) * 10000).cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(5,4)") if c in FRACTIONS else F.col(c)
                value = own.cast("decimal(38,4)") + F.lit(correction if i == 0 else 0)
                cols.append(F.when(at % (5 + i) == 0, F.lit(_DIRT[i % 4])).otherwise(value.cast("decimal(38,4)").cast("string")).alias(c))
            else:
                cols.append(F.col(c).cast("string").alias(c))
        return rows.select(*cols, F.lit(part).cast("date").alias("batch_date"), F.lit(path).alias("src_file"), F.lit(1).cast("bigint").alias("src_row"),
                           F.lit(part).alias("part_key"), F.lit(loaded_at).cast("timestamp").alias("loaded_at"))

    rows = src.proxy(spark, d)
    return load(rows, 0, f"landing/{name}/1.parquet", B.LOAD1_AT, "2024-01-01").unionByName(
        load(rows.where(at % 3 == 1), 1, f"landing/{name}/2.parquet", B.LOAD2_AT, "2024-01-02"))


def _text_sql(name: str, correction: int, where: str, at: str) -> str:
    src, numbers = SOURCES[name], _numbers(name)
    cols = []
    for c in feed(name).bronze_columns:
        if c not in src.columns:
            cols.append(f"CAST(NULL AS VARCHAR) AS {c}")
        elif c in numbers:
            i = numbers.index(c)
            own = f"CAST(CAST(FLOOR({c} * 10000) AS BIGINT) AS DECIMAL(18,0)) * CAST('0.0001' AS DECIMAL(5,4))" if c in FRACTIONS else c
            cols.append(f"CASE WHEN {src.sql_number} % {5 + i} = 0 THEN '{_DIRT[i % 4]}' "
                        f"ELSE CAST(CAST({own} AS DECIMAL(38,4)) + {correction if i == 0 else 0} AS VARCHAR) END AS {c}")
        else:
            cols.append(f"CAST({c} AS VARCHAR) AS {c}")
    return f"SELECT {', '.join(cols)}, TIMESTAMP '{at}' AS loaded_at FROM {src.cte} {where}"


def silver_sql(name: str) -> list[tuple[str, str]]:
    """CTEs b_<feed> (bronze) and s_<feed> (silver, decimals as double)."""
    f, src = feed(name), SOURCES[name]

    def cast(c: str, code: str) -> str:
        if code.startswith("S"):
            return f"substr({c}, 1, {code[1:]}) AS {c}"
        kind = {"N": "DECIMAL(38,4)", "I": "INTEGER", "D": "DATE", "T": "TIMESTAMP"}[code]
        guarded = f"TRY_CAST(CASE WHEN lower({c}) IN ({_TOKENS}) THEN NULL ELSE {c} END AS {kind})"
        return f"CAST({guarded} AS DOUBLE) AS {c}" if code == "N" else f"{guarded} AS {c}"

    loads = _text_sql(name, 0, "", B.LOAD1_AT) + " UNION ALL " + _text_sql(name, 1, f"WHERE {src.sql_number} % 3 = 1", B.LOAD2_AT)
    newest = f"SELECT *, ROW_NUMBER() OVER (PARTITION BY {', '.join(f.keys)} ORDER BY loaded_at DESC) AS rn FROM b_{name}"
    return [(f"b_{name}", loads), (f"s_{name}", f"SELECT {', '.join(cast(c, k) for c, k in f.columns)} FROM ({newest}) WHERE rn = 1")]


def _register(name: str) -> None:
    @register(f"silver_{name}", with_proxies([SOURCES[name].cte], silver_sql(name), f"SELECT * FROM s_{name}"))
    def run(spark: SparkSession, d: str) -> DataFrame:
        return marts.plain(to_silver(bronze(spark, d, name), name, audit=False))


for _name in SOURCES:
    _register(_name)


@register("silver_to_macro", with_proxies(
    ["rates", "fx", "commodities", "macro"],
    [c for n in ("interest_rates", "exchange_rates", "commodities_price", "macro_indicators") for c in silver_sql(n)],
    "SELECT * FROM (WITH rates AS (SELECT * FROM s_interest_rates), fx AS (SELECT * FROM s_exchange_rates), "
    "commodities AS (SELECT * FROM s_commodities_price), macro AS (SELECT * FROM s_macro_indicators), "
    + ", ".join(f"{n} AS ({body})" for n, body in OM.MACRO) + " SELECT * FROM macro_mart)"))
def silver_to_macro(spark: SparkSession, d: str) -> DataFrame:
    """Bronze text -> silver decimals with NULLs -> the macro mart, in one plan."""
    s = {n: to_silver(bronze(spark, d, n), n, audit=False) for n in ("interest_rates", "exchange_rates", "macro_indicators", "commodities_price")}
    return marts.macro_mart(*s.values())


@register("silver_to_flows", with_proxies(
    ["foreign_flow", "prop_flow"], silver_sql("foreign_trading") + silver_sql("proprietary_trading"),
    "SELECT * FROM (WITH foreign_flow AS (SELECT ticker, trading_date, CAST(buy_vol AS BIGINT) AS buy_vol, CAST(sell_vol AS BIGINT) AS sell_vol, "
    "CAST(buy_val AS BIGINT) AS buy_val, CAST(sell_val AS BIGINT) AS sell_val, CAST(net_val AS BIGINT) AS net_val FROM s_foreign_trading), "
    "prop_flow AS (SELECT ticker, trading_date, CAST(net_val AS BIGINT) AS net_val FROM s_proprietary_trading), "
    + ", ".join(f"{n} AS ({body})" for n, body in OM.FLOWS)
    + " SELECT ticker, trading_date, ROUND(foreign_buy_ratio_10d, 9) AS foreign_buy_ratio_10d, CAST(net_foreign_flow_1m AS DOUBLE) AS net_foreign_flow_1m, "
    "ROUND(net_foreign_flow_momentum_1m, 9) AS net_foreign_flow_momentum_1m, CAST(prop_trading_net_val_5d AS DOUBLE) AS prop_trading_net_val_5d, "
    "ROUND(prop_vs_foreign_correlation_10d, 9) AS prop_vs_foreign_correlation_10d FROM flows)"))
def silver_to_flows(spark: SparkSession, d: str) -> DataFrame:
    """Bronze text -> silver decimals with NULLs -> the flows mart; ratios at nine places."""
    foreign, prop = (to_silver(bronze(spark, d, n), n, audit=False) for n in ("foreign_trading", "proprietary_trading"))
    out = marts.flows_mart(foreign, prop)
    ratios = ("foreign_buy_ratio_10d", "net_foreign_flow_momentum_1m", "prop_vs_foreign_correlation_10d")
    return out.select(*[F.round(c, 9).alias(c) if c in ratios else F.col(c) for c in out.columns])

"""Feed catalogue: bronze columns, silver types and merge keys for the 15 feeds.

Type codes: ``S`` string (``S256`` truncates to 256 chars, as VARCHAR(256)
does in the silver layer), ``N`` decimal(38,4), ``I`` int, ``D`` date,
``T`` timestamp.  Every non-string cast goes through the null-token guard.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Text treated as NULL before a cast (lower-cased compare).
NULL_TOKENS = ("nan", "", "none", "<na>")

# Lineage columns added to every bronze row (ours; see SURVEY 1.3).
LINEAGE_COLUMNS = ("batch_date", "src_file", "src_row", "part_key", "loaded_at")
# Audit columns added to every silver/gold row.
AUDIT_COLUMNS = ("created_at", "created_by_job", "created_by", "updated_at", "updated_by_job", "updated_by",
                 "batch_date")
CREATED_COLUMNS = ("created_at", "created_by_job", "created_by")

DECIMAL = T.DecimalType(38, 4)


@dataclass(frozen=True)
class Feed:
    name: str
    keys: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]  # (column, type code) in silver order
    fallbacks: dict[str, str] = field(default_factory=dict)  # column -> column used when NULL

    @property
    def bronze_columns(self) -> list[str]:
        return [c for c, _ in self.columns]

    def bronze_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.bronze_columns])

    def silver_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, spark_type(t), True) for c, t in self.columns])


def spark_type(code: str) -> T.DataType:
    if code.startswith("S"):
        return T.StringType()
    return {"N": DECIMAL, "I": T.IntegerType(), "D": T.DateType(), "T": T.TimestampType()}[code]


def _f(name, keys, cols, **kw) -> Feed:
    return Feed(name, tuple(keys), tuple(tuple(c.split(":")) for c in cols), **kw)


FEEDS: dict[str, Feed] = {f.name: f for f in [
    _f("stock_price_eod", ["ticker", "trading_date"],
       ["ticker:S256", "trading_date:D", "open:N", "high:N", "low:N", "close:N", "volume:N", "value:N",
        "adjusted_close:N"], fallbacks={"adjusted_close": "close"}),
    _f("index_price_eod", ["index_name", "trading_date"],
       ["index_name:S256", "trading_date:D", "open:N", "high:N", "low:N", "close:N", "volume:N"]),
    _f("foreign_trading", ["ticker", "trading_date"],
       ["ticker:S256", "trading_date:D", "buy_vol:N", "sell_vol:N", "buy_val:N", "sell_val:N", "net_val:N"]),
    _f("proprietary_trading", ["ticker", "trading_date"],
       ["ticker:S256", "trading_date:D", "buy_vol:N", "sell_vol:N", "net_val:N"]),
    _f("balance_sheet", ["ticker", "period", "year"],
       ["ticker:S256", "period:S256", "year:I", "total_assets:N", "current_assets:N", "cash:N", "inventory:N",
        "total_liabilities:N", "short_term_debt:N", "long_term_debt:N", "equity:N"]),
    _f("income_statement", ["ticker", "period", "year"],
       ["ticker:S256", "period:S256", "year:I", "revenue:N", "cogs:N", "gross_profit:N", "operating_expenses:N",
        "operating_profit:N", "financial_income:N", "financial_expenses:N", "net_profit_after_tax:N"]),
    _f("cashflow_statement", ["ticker", "period", "year"],
       ["ticker:S256", "period:S256", "year:I", "cfo:N", "cfi:N", "cff:N", "net_cash_flow:N", "capex:N"]),
    _f("company_profile", ["ticker"],
       ["ticker:S256", "company_name:S512", "industry:S256", "exchange:S256", "outstanding_share:N",
        "description:S65535"]),
    _f("macro_indicators", ["indicator_name", "report_date"],
       ["indicator_name:S256", "report_date:D", "value:N", "unit:S256"]),
    _f("interest_rates", ["rate_type", "date"], ["rate_type:S256", "date:D", "rate_value:N"]),
    _f("exchange_rates", ["pair", "date"], ["pair:S256", "date:D", "exchange_rate:N"]),
    _f("commodities_price", ["commodity_name", "date"], ["commodity_name:S256", "date:D", "price:N"]),
    _f("news_articles", ["article_id"],
       ["article_id:S256", "ticker:S256", "publish_time:T", "title:S256", "summary:S256", "content:S256",
        "source:S256", "url:S256"]),
    _f("corporate_events", ["event_id"],
       ["event_id:S256", "ticker:S256", "event_type:S256", "ex_right_date:D", "record_date:D",
        "event_details:S256"]),
    _f("analyst_reports", ["report_id"],
       ["report_id:S256", "ticker:S256", "brokerage_firm:S256", "publish_date:D", "title:S256",
        "description:S8000", "file_name:S256"]),
]}


def feed(name: str) -> Feed:
    if name not in FEEDS:
        raise ValueError(f"unknown feed {name!r}; known: {sorted(FEEDS)}")
    return FEEDS[name]

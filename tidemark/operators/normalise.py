"""Vendor dump -> bronze row mappings for the 15 feeds (NRM1-NRM19).

Raw dumps are read as DataFrames (one row per vendor record).  The symbol a
record was requested for travels as a column (``request_col``, taken from the
landing path or the dump) so one job normalises all symbols at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import period_to_date
from tidemark.operators.conform import conform
from tidemark.operators.dedupe import latest_by
from tidemark.session import small_side

# Vendor field -> our column, per feed.
NEWS_FIELDS = {
    "id": "article_id", "news_title": "title", "news_sub_title": "summary", "news_full_content": "content",
    "news_source": "source", "news_source_link": "url", "public_date": "publish_time",
}
EVENT_FIELDS = {"id": "event_id", "category": "event_type", "exright_date": "ex_right_date",
                "event_title_vi": "event_details"}
PROFILE_FIELDS = {"symbol": "ticker", "organ_name": "company_name", "sector": "industry",
                  "com_group_code": "exchange", "issue_share": "outstanding_share", "company_profile": "description"}
REPORT_FIELDS = {"reportID": "report_id", "sourceName": "brokerage_firm", "date": "publish_date", "title": "title",
                 "description": "description", "fileName": "file_name"}
# Default index list, quote codes by our name, and the default symbol universe.
DEFAULT_INDICES = ("VNINDEX", "HNXINDEX")
COMMODITY_CODES = {"Brent Crude": "BZ=F", "WTI": "CL=F", "Gasoline Singapore (92/95)": "RB=F",
                   "Baltic Dirty Tanker Index": "^BDTI", "Gold": "GC=F", "Steel HRC": "HR=F"}
CURRENCY_CODES = {"USD/VND": "USDVND=X", "EUR/VND": "EURVND=X", "GBP/VND": "GBPVND=X", "JPY/VND": "JPYVND=X",
                  "CNY/VND": "CNYVND=X"}
RATE_CODES = {"us_fed_funds_rate": "^IRX", "us_10y_treasury": "^TNX", "us_5y_treasury": "^FVX"}
DEFAULT_UNIVERSE = ("ACB", "BCM", "BID", "BVH", "CTG", "FPT", "GAS", "GVR", "HDB", "HPG", "MBB", "MSN", "MWG", "PLX",
                    "PNJ", "POW", "SAB", "SHB", "SSB", "SSI", "STB", "TCB", "TPB", "VCB", "VHM", "VIC", "VJC", "VNM",
                    "VPB", "VRE")


def _has(df: DataFrame, c: str) -> bool:
    return c.lower() in {x.lower() for x in df.columns}


def _col_or_null(df: DataFrame, c: str) -> Column:
    return F.col(f"`{c}`") if _has(df, c) else F.lit(None).cast("string")


def _sym(request: str | Column) -> Column:
    return F.col(request) if isinstance(request, str) else request


def rename_fields(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    present = {k: v for k, v in mapping.items() if _has(df, k)}
    return df.withColumnsRenamed(present)


def norm_stock_price(raw: DataFrame, request: str | Column = "symbol") -> DataFrame:
    """NRM1: time -> trading_date (first 10 chars), ticker from the request when
    absent, vendor-less value / adjusted_close added as NULL."""
    df = rename_fields(raw, {"time": "trading_date"})
    ticker = F.coalesce(_col_or_null(df, "ticker"), _sym(request))
    return df.select(
        ticker.cast("string").alias("ticker"),
        F.substring(F.col("trading_date").cast("string"), 1, 10).alias("trading_date"),
        *[_col_or_null(df, c).cast("string").alias(c) for c in ("open", "high", "low", "close", "volume")],
        _col_or_null(df, "value").cast("string").alias("value"),
        _col_or_null(df, "adjusted_close").cast("string").alias("adjusted_close"),
    )


def norm_index_price(raw: DataFrame, request: str | Column = "symbol",
                     indices: Sequence[str] = DEFAULT_INDICES) -> DataFrame:
    """NRM2: as NRM1 with index_name from the request, restricted to the index list."""
    df = rename_fields(raw, {"time": "trading_date"})
    out = df.select(
        _sym(request).cast("string").alias("index_name"),
        F.substring(F.col("trading_date").cast("string"), 1, 10).alias("trading_date"),
        *[_col_or_null(df, c).cast("string").alias(c) for c in ("open", "high", "low", "close", "volume")],
    )
    return out.where(F.col("index_name").isin(list(indices)))


def norm_foreign_flow(raw: DataFrame, request: str | Column = "symbol") -> DataFrame:
    """NRM3: pick the four flow fields (missing -> 0), net = buy - sell value."""
    def g(c: str) -> Column:
        return F.coalesce(_col_or_null(raw, c).cast("bigint"), F.lit(0).cast("bigint"))

    buy_val, sell_val = g("buyForeignValue"), g("sellForeignValue")
    return raw.select(
        _sym(request).cast("string").alias("ticker"),
        F.substring(F.coalesce(F.col("date").cast("string"), F.lit("")), 1, 10).alias("trading_date"),
        g("buyForeignQuantity").alias("buy_vol"), g("sellForeignQuantity").alias("sell_vol"),
        buy_val.alias("buy_val"), sell_val.alias("sell_val"), (buy_val - sell_val).alias("net_val"),
    )


def norm_prop_flow(raw: DataFrame, request: str | Column = "symbol") -> DataFrame:
    """NRM4: net-only desk flow; zero-net days dropped; volumes are the text '0'."""
    net = F.coalesce(_col_or_null(raw, "propTradingNetValue").cast("bigint"), F.lit(0).cast("bigint"))
    out = raw.select(
        _sym(request).cast("string").alias("ticker"),
        F.substring(F.coalesce(F.col("date").cast("string"), F.lit("")), 1, 10).alias("trading_date"),
        net.alias("__net"),
    ).where(F.col("__net") != 0)
    return out.select("ticker", "trading_date", F.lit("0").alias("buy_vol"), F.lit("0").alias("sell_vol"),
                      F.col("__net").cast("string").alias("net_val"))


def norm_profile(raw: DataFrame, columns: Sequence[str] = ("ticker", "company_name", "industry", "exchange",
                                                          "outstanding_share", "description")) -> DataFrame:
    """NRM5: vendor names -> ours, keep the schema columns that are present."""
    df = rename_fields(raw, PROFILE_FIELDS)
    return df.select(*[F.col(c) for c in columns if _has(df, c)])


def norm_events(raw: DataFrame, request: str | Column = "symbol") -> DataFrame:
    """NRM6: rename; NULL / absent ticker filled with the requested symbol."""
    df = rename_fields(raw, EVENT_FIELDS)
    return df.select(
        _col_or_null(df, "event_id").cast("string").alias("event_id"),
        F.coalesce(_col_or_null(df, "ticker").cast("string"), _sym(request)).alias("ticker"),
        *[_col_or_null(df, c).cast("string").alias(c) for c in ("event_type", "ex_right_date", "record_date",
                                                                "event_details")],
    )


def norm_news(raw: DataFrame, request: str = "symbol") -> DataFrame:
    """NRM7: rename the 7 vendor fields; the ticker is filled only when *every*
    record of that symbol's batch lacks one.  "Every record" is a per-symbol
    aggregate (partial aggregation, one row per symbol) joined back, so a symbol
    with a huge batch never sits in one task."""
    df = rename_fields(raw, NEWS_FIELDS)
    tick = _col_or_null(df, "ticker").cast("string")
    df = df.withColumn("__tick", tick)
    any_tick = df.groupBy(F.col(request).alias("__sym")).agg(F.max("__tick").alias("__any"))
    j = df.join(small_side(any_tick), df[request] == F.col("__sym"), "left")
    return j.select(
        _col_or_null(df, "article_id").cast("string").alias("article_id"),
        F.when(F.col("__any").isNull(), F.col(request)).otherwise(F.col("__tick")).alias("ticker"),
        *[_col_or_null(df, c).cast("string").alias(c) for c in ("publish_time", "title", "summary", "content",
                                                                "source", "url")],
    )


def norm_reports(raw: DataFrame, request: str | Column = "symbol") -> DataFrame:
    """NRM8: 7 fields; ticker = vendor symbol unless empty, else the request."""
    df = rename_fields(raw, REPORT_FIELDS)
    vendor = F.nullif(_col_or_null(raw, "symbol").cast("string"), F.lit(""))
    return df.select(
        _col_or_null(df, "report_id").cast("string").alias("report_id"),
        F.coalesce(vendor, _sym(request)).alias("ticker"),
        *[_col_or_null(df, c).cast("string").alias(c) for c in ("brokerage_firm", "publish_date", "title",
                                                                "description", "file_name")],
    )


def _date_column(df: DataFrame) -> str:
    for c in df.columns:
        if c.lower() in ("date", "datetime", "index"):
            return c
    raise ValueError(f"no date column among {df.columns}")


def code_frame(spark, codes: Mapping[str, str], name_col: str, code_col: str = "code") -> DataFrame:
    """A code mapping such as ``COMMODITY_CODES`` as a small table (code, name)."""
    return spark.createDataFrame([(c, n) for n, c in codes.items()], f"{code_col} string, {name_col} string")


def norm_quotes(raw: DataFrame, mapping: DataFrame | Mapping[str, str], name_col: str, value_col: str,
                code_col: str = "code", request: str = "symbol") -> DataFrame:
    """NRM9-NRM11: market quotes (commodities, FX pairs, rates) -> (name, date, value).

    The date column is found by name (case-insensitive), ISO-formatted; the
    vendor code of each row is labelled through a small mapping table
    (broadcast behind a size check); the Close price becomes the value text.
    A code that the mapping lacks keeps its row under the code itself."""
    if not isinstance(mapping, DataFrame):
        mapping = code_frame(raw.sparkSession, mapping, name_col, code_col)
    dc = _date_column(raw)
    close = next(c for c in raw.columns if c.lower() == "close")
    q = raw.select(F.col(request).alias(code_col), F.date_format(F.col(f"`{dc}`").cast("timestamp"), "yyyy-MM-dd")
                   .alias("date"), F.col(f"`{close}`").cast("string").alias(value_col))
    m = small_side(mapping.select(F.col(code_col), F.col(name_col)))
    named = q.join(m, code_col, "left")
    return named.select(F.coalesce(name_col, code_col).alias(name_col), "date", value_col)


def latest_non_null_macro(raw: DataFrame, name_col: str = "indicator_name") -> DataFrame:
    """NRM12 + NRM14: newest record per indicator whose value is present; the
    period text becomes a date; value as text; unit defaults to ''."""
    rows = raw.where(F.col("value").isNotNull()).withColumn("report_date", period_to_date("date"))
    newest = latest_by(rows, [name_col], [F.col("report_date").desc()])
    return newest.select(name_col, F.col("report_date").cast("string").alias("report_date"),
                         F.col("value").cast("string").alias("value"),
                         F.coalesce(F.col("unit"), F.lit("")).alias("unit"))


def macro_history(raw: DataFrame, lo: str, hi: str, name_col: str = "indicator_name") -> DataFrame:
    """NRM13: every non-null record whose period date is inside [lo, hi]."""
    rows = raw.where(F.col("value").isNotNull()).withColumn("report_date", period_to_date("date"))
    return rows.where(F.col("report_date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date"))).select(
        name_col, F.col("report_date").cast("string").alias("report_date"),
        F.col("value").cast("string").alias("value"), F.coalesce(F.col("unit"), F.lit("")).alias("unit"))


def in_range(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """NRM18: keep rows whose ISO date text is inside [lo, hi]."""
    d = F.substring(F.col(col).cast("string"), 1, 10)
    return df.where((d >= F.lit(lo)) & (d <= F.lit(hi)))


def restrict_universe(df: DataFrame, symbols: DataFrame | None, key: str = "ticker") -> DataFrame:
    """NRM19: keep rows of the symbol universe (semi join); None keeps all."""
    if symbols is None:
        return df
    return df.join(small_side(symbols.select(key).distinct()), key, "left_semi")


# -- statements: label maps, long -> wide (NRM15-NRM17) ------------------------------
def label_map_frame(spark, maps: Sequence[Mapping[str, str]]) -> DataFrame:
    """(map_id, label, column) rows; ``map_id`` order is the priority on ties."""
    rows = [(i, label, col) for i, m in enumerate(maps) for label, col in m.items()]
    return spark.createDataFrame(rows, "map_id int, label string, column string")


def pick_label_map(items: DataFrame, label_maps: DataFrame, key: str = "ticker", label: str = "item_en") -> DataFrame:
    """NRM15: per symbol, the map matching the most labels (first map wins ties;
    no match -> the symbol is dropped).  Returns (key, map_id)."""
    lm = small_side(label_maps.select("map_id", F.col("label").alias(label)))
    hits = items.select(key, label).distinct().join(lm, label).groupBy(key, "map_id").agg(
        F.count(F.lit(1)).alias("hits"))
    return latest_by(hits, [key], [F.col("hits").desc(), F.col("map_id").asc()]).select(key, "map_id")


def statement_wide(items: DataFrame, label_maps: DataFrame, columns: Sequence[str], *, key: str = "ticker",
                   label: str = "item_en", period_col: str = "period_label", value: str = "value",
                   latest_only: bool = False) -> DataFrame:
    """NRM16/NRM17: long items (key, label, 'YYYY-Qn', value) -> one row per
    (key, year, period) with a fixed column list (absent items -> NULL).

    Only period labels containing '-' are periods.  ``latest_only`` keeps the
    newest period of each symbol."""
    chosen = pick_label_map(items, label_maps, key, label)
    lm = small_side(label_maps.select("map_id", F.col("label").alias(label), "column"))
    long = items.where(F.col(period_col).contains("-")).join(chosen, key).join(lm, [label, "map_id"])
    parts = F.split(F.col(period_col), "-")
    long = long.select(key, parts.getItem(0).alias("year"), parts.getItem(1).alias("period"),
                       F.col("column"), F.col(value).cast("string").alias("v"))
    if latest_only:
        newest = latest_by(long.select(key, "year", "period").distinct(), [key],
                           [F.col("year").desc(), F.col("period").desc()])
        long = long.join(newest, [key, "year", "period"], "left_semi")
    wide = long.groupBy(key, "year", "period").pivot("column", list(columns)).agg(F.first("v"))
    return conform(wide, [key, "period", "year", *columns])


def unpivot_periods(wide_items: DataFrame, id_cols: Sequence[str]) -> DataFrame:
    """Vendor layout (items as rows, one column per period) -> long rows."""
    period_cols = [c for c in wide_items.columns if c not in id_cols]
    return wide_items.unpivot(list(id_cols), period_cols, "period_label", "value")


# Vendor statement labels -> our columns; corporate map first,
# bank map second (first wins a tie in NRM15).
INCOME_MAPS = (
    {"Sales": "revenue", "Cost of sales": "cogs", "Gross Profit": "gross_profit",
     "General and admin expenses": "operating_expenses", "Operating profit/(loss)": "operating_profit",
     "Financial income": "financial_income", "Financial expenses": "financial_expenses",
     "Net profit/(loss) after tax": "net_profit_after_tax"},
    {"Total Operating Income": "revenue", "General and Admin Expenses": "operating_expenses",
     "Net Operating Profit Before Allowance for Credit Loss": "operating_profit",
     "Interest and Similar Income": "financial_income", "Interest and Similar Expenses": "financial_expenses",
     "Net profit/(loss) after tax": "net_profit_after_tax"},
)
BALANCE_MAPS = (
    {"Total Assets": "total_assets", "CURRENT ASSETS": "current_assets", "Cash and cash equivalents": "cash",
     "Inventories, Net": "inventory", "Liabilities": "total_liabilities", "Short-term borrowings": "short_term_debt",
     "Long-term borrowings": "long_term_debt", "Capital and reserves": "equity"},
    {"TOTAL ASSETS": "total_assets", "Cash and precious metals": "cash", "TOTAL LIABILITIES": "total_liabilities",
     "OWNER'S EQUITY": "equity"},
)
CASHFLOW_MAPS = (
    {"Net cash inflows/(outflows) from operating activities": "cfo",
     "Net cash inflows/(outflows) from investing activities": "cfi",
     "Net cash inflows/(outflows) from financing activities": "cff",
     "Net increase in cash and cash equivalents": "net_cash_flow",
     "Purchases of fixed assets and other long term assets": "capex"},
    {"Net cash from operating activities": "cfo", "Net cash from investing activities": "cfi",
     "Net Increase/(Decrease) in cash and cash equivalents": "net_cash_flow",
     "Purchases of fixed assets and other long term assets": "capex"},
)

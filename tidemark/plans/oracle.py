"""Independent SQL (DuckDB dialect) for every registered query.

These strings are the correctness oracle: the same proxy tables and features
written once more as plain SQL over the driver's views, so a Spark plan and a
second engine must agree.  Integer-cent arithmetic mirrors the Spark side.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Proxy market tables as CTE bodies.
# ---------------------------------------------------------------------------
LINES = """
  SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_returnflag, l.l_linestatus, l.l_shipdate,
         p.p_brand, CAST(ROUND(l.l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""

PRICE = """
  SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS trading_date,
         arg_min(cents, l_orderkey * 8 + l_linenumber) AS open_cents,
         MAX(cents) AS high_cents, MIN(cents) AS low_cents, MAX(cents) AS close_cents,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume,
         CAST(SUM(cents) AS BIGINT) AS value_cents,
         CAST(MAX(cents) AS DOUBLE) / 100 AS adjusted_close,
         CAST(MAX(cents) AS DOUBLE) / 100 AS close
  FROM lines GROUP BY 1, 2
"""

INDEX = """
  SELECT 'VNINDEX' AS index_name, CAST(l_shipdate AS DATE) AS trading_date,
         CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS close
  FROM lineitem GROUP BY 2
"""

FOREIGN = """
  SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS trading_date,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS buy_vol,
         CAST(SUM(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS sell_vol,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN cents ELSE 0 END) AS BIGINT) AS buy_val,
         CAST(SUM(CASE WHEN l_returnflag <> 'R' THEN cents ELSE 0 END) AS BIGINT) AS sell_val,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN cents ELSE -cents END) AS BIGINT) AS net_val
  FROM lines WHERE l_linestatus = 'O' GROUP BY 1, 2
"""

PROP = """
  SELECT * FROM (
    SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS trading_date,
           CAST(SUM(CASE WHEN l_returnflag = 'N' THEN cents ELSE -cents END) AS BIGINT) AS net_val
    FROM lines WHERE l_linestatus = 'F' GROUP BY 1, 2
  ) WHERE net_val <> 0
"""

QUARTERLY = """
  SELECT *, CAST(year(l_shipdate) AS INTEGER) AS year, 'Q' || CAST(quarter(l_shipdate) AS VARCHAR) AS period
  FROM lines
"""

INCOME = """
  SELECT ticker, period, year, revenue, cogs, revenue - cogs AS gross_profit, operating_expenses,
         revenue - cogs - operating_expenses AS operating_profit, financial_income, financial_expenses,
         revenue - cogs - operating_expenses + financial_income - financial_expenses AS net_profit_after_tax
  FROM (
    SELECT p_brand AS ticker, period, year,
           CAST(SUM(cents) AS BIGINT) AS revenue,
           CAST(SUM(CASE WHEN l_linestatus = 'F' THEN cents ELSE 0 END) AS BIGINT) AS cogs,
           CAST(SUM(CASE WHEN l_returnflag = 'A' THEN cents ELSE 0 END) AS BIGINT) AS operating_expenses,
           CAST(SUM(CAST(l_quantity AS BIGINT) * 100) AS BIGINT) AS financial_income,
           CAST(SUM(CAST(l_linenumber AS BIGINT) * 1000) AS BIGINT) AS financial_expenses
    FROM quarterly GROUP BY 1, 2, 3)
"""

BALANCE = """
  SELECT *, total_assets - total_liabilities AS equity FROM (
    SELECT p_brand AS ticker, period, year,
           CAST(SUM(cents) + SUM(CAST(l_quantity AS BIGINT) * 100000) AS BIGINT) AS total_assets,
           CAST(SUM(CASE WHEN l_linestatus = 'O' THEN cents ELSE 0 END) AS BIGINT) AS current_assets,
           CAST(SUM(CASE WHEN l_returnflag = 'N' THEN cents ELSE 0 END) AS BIGINT) AS cash,
           CAST(SUM(CAST(l_quantity AS BIGINT) * 1000) AS BIGINT) AS inventory,
           CAST(SUM(CASE WHEN l_returnflag = 'R' THEN cents ELSE 0 END) AS BIGINT) AS total_liabilities,
           CAST(SUM(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN cents ELSE 0 END) AS BIGINT) AS short_term_debt,
           CAST(SUM(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN cents ELSE 0 END) AS BIGINT) AS long_term_debt
    FROM quarterly GROUP BY 1, 2, 3)
"""

CASHFLOW = """
  SELECT *, cfo + cfi + cff AS net_cash_flow FROM (
    SELECT p_brand AS ticker, period, year,
           CAST(SUM(CASE WHEN l_linestatus = 'O' THEN cents ELSE 0 END)
                - SUM(CASE WHEN l_returnflag = 'R' THEN cents ELSE 0 END) AS BIGINT) AS cfo,
           CAST(-SUM(CASE WHEN l_returnflag = 'A' THEN cents ELSE 0 END) AS BIGINT) AS cfi,
           CAST(SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) * 1000 ELSE 0 END) AS BIGINT) AS cff,
           CAST(SUM(CAST(l_quantity AS BIGINT) * 500) AS BIGINT) AS capex
    FROM quarterly GROUP BY 1, 2, 3)
"""

PROFILE = """
  SELECT p_brand AS ticker, min(p_type) AS industry, COUNT(*) * 1000000 AS outstanding_share
  FROM part GROUP BY 1
"""

ORDERS = """
  SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority,
         CAST(ROUND(o_totalprice * 100) AS BIGINT) AS cents
  FROM orders
"""

RATES = """
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN '^IRX' WHEN '2-HIGH' THEN '^TNX' WHEN '3-MEDIUM' THEN '^FVX' END
           AS rate_type,
         CAST(o_orderdate AS DATE) AS date,
         CAST(SUM(cents) AS DOUBLE) / COUNT(*) / 100000 AS rate_value
  FROM ords WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1, 2
"""

FX = """
  SELECT CASE o_orderstatus WHEN 'F' THEN 'USD/VND' WHEN 'O' THEN 'EUR/VND' WHEN 'P' THEN 'GBP/VND' END AS pair,
         CAST(o_orderdate AS DATE) AS date, CAST(SUM(cents) AS DOUBLE) / COUNT(*) / 10 AS exchange_rate
  FROM ords GROUP BY 1, 2
"""

COMMODITIES = """
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'Brent Crude' WHEN '2-HIGH' THEN 'WTI'
              WHEN '3-MEDIUM' THEN 'Gold' WHEN '4-NOT SPECIFIED' THEN 'Steel HRC'
              WHEN '5-LOW' THEN 'Gasoline RON95 Singapore' END AS commodity_name,
         CAST(o_orderdate AS DATE) AS date, CAST(MAX(cents) AS DOUBLE) / 100 AS price
  FROM ords GROUP BY 1, 2
  UNION ALL
  SELECT 'Baltic Dirty Tanker Index', CAST(o_orderdate AS DATE), CAST(MIN(cents) AS DOUBLE) / 100
  FROM ords WHERE o_orderstatus = 'P' GROUP BY 2
"""

MACRO = """
  SELECT 'CPI' AS indicator_name, report_date, CAST(n AS DOUBLE) / 100 AS value, '%' AS unit FROM macro_m
  UNION ALL
  SELECT 'INTEREST_RATE', report_date, CAST(total_cents AS DOUBLE) / n / 1000000, '%' FROM macro_m
"""

MACRO_M = """
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS report_date, COUNT(*) AS n,
         CAST(SUM(cents) AS BIGINT) AS total_cents
  FROM ords GROUP BY 1
"""

NEWS = """
  SELECT CAST(event_id AS VARCHAR) AS article_id, CAST(user_id AS VARCHAR) AS ticker, ts AS publish_time
  FROM events WHERE event_type IN ('view', 'click')
"""

ANALYST = """
  SELECT CAST(event_id AS VARCHAR) AS report_id, CAST(user_id AS VARCHAR) AS ticker,
         CAST(ts AS DATE) AS publish_date
  FROM events WHERE event_type = 'purchase'
"""

CORP_EVENTS = """
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS ticker,
         CASE WHEN event_type = 'signup' THEN 'Cash dividend' ELSE 'Rights issue' END AS event_type,
         CASE WHEN event_type = 'signup' THEN CAST(ts AS DATE) END AS ex_right_date,
         CASE WHEN event_type <> 'signup' THEN CAST(ts AS DATE) END AS record_date,
         CAST(ts AS DATE) AS batch_date
  FROM events WHERE event_type IN ('signup', 'error')
"""

# name -> (body, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "lines": (LINES, ()),
    "price": (PRICE, ("lines",)),
    "idx": (INDEX, ()),
    "foreign_flow": (FOREIGN, ("lines",)),
    "prop_flow": (PROP, ("lines",)),
    "quarterly": (QUARTERLY, ("lines",)),
    "income": (INCOME, ("quarterly",)),
    "balance": (BALANCE, ("quarterly",)),
    "cashflow": (CASHFLOW, ("quarterly",)),
    "profile": (PROFILE, ()),
    "ords": (ORDERS, ()),
    "rates": (RATES, ("ords",)),
    "fx": (FX, ("ords",)),
    "commodities": (COMMODITIES, ("ords",)),
    "macro_m": (MACRO_M, ("ords",)),
    "macro": (MACRO, ("macro_m",)),
    "news": (NEWS, ()),
    "analyst": (ANALYST, ()),
    "corp_events": (CORP_EVENTS, ()),
}


def with_proxies(names: list[str] | tuple[str, ...], extra: list[tuple[str, str]], final: str) -> str:
    """Assemble ``WITH`` + the needed proxy CTEs (dependency order) + extra CTEs + final select."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in CTES[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTES[n][0]})" for n in order] + [f"{n} AS ({body})" for n, body in extra]
    recursive = any(f" {n} " in body for n, body in extra)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + final

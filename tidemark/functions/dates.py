"""Date column helpers (F14, F16, F17, NRM14, FN-date)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def available_on(year: str | Column, period: str | Column) -> Column:
    """Date a quarterly report becomes public (F14): Q1 -> 1 May, Q2 -> 1 Aug,
    Q3 -> 1 Nov, Q4 -> 1 Feb next year, anything else -> 1 Apr next year.
    The quarter digit is searched in the upper-cased period text, in 1..4 order."""
    y = _c(year).cast("int")
    p = F.upper(_c(period).cast("string"))
    return (
        F.when(p.contains("1"), F.make_date(y, F.lit(5), F.lit(1)))
        .when(p.contains("2"), F.make_date(y, F.lit(8), F.lit(1)))
        .when(p.contains("3"), F.make_date(y, F.lit(11), F.lit(1)))
        .when(p.contains("4"), F.make_date(y + 1, F.lit(2), F.lit(1)))
        .otherwise(F.make_date(y + 1, F.lit(4), F.lit(1)))
    )


def next_weekday(d: str | Column) -> Column:
    """Next Monday-Friday after ``d`` (F16): Fri -> Mon, Sat -> Mon, else +1."""
    d = _c(d)
    dow = F.dayofweek(d)  # 1 = Sunday ... 7 = Saturday
    return F.date_add(d, F.when(dow == 6, 3).when(dow == 7, 2).otherwise(1))


def iso_day(s: str | Column) -> Column:
    """Validate/normalise the first 10 characters as an ISO date (F17); NULL if invalid."""
    return F.try_to_date(F.substring(_c(s).cast("string"), 1, 10), F.lit("yyyy-MM-dd"))


def period_to_date(s: str | Column) -> Column:
    """Vendor period text to a date (NRM14): '2024' -> 2024-01-01,
    '2024M06' -> 2024-06-01, '2024Q2' -> 2024-04-01 (first month of the quarter)."""
    s = _c(s).cast("string")
    year = F.regexp_extract(s, r"^(\d{4})", 1).cast("int")
    month = F.regexp_extract(s, r"M(\d{1,2})$", 1).cast("int")
    quarter = F.regexp_extract(s, r"Q(\d)$", 1).cast("int")
    return (
        F.when(s.contains("M"), F.make_date(year, month, F.lit(1)))
        .when(s.contains("Q"), F.make_date(year, (quarter - 1) * 3 + 1, F.lit(1)))
        .when(s.rlike(r"^\d{4}$"), F.make_date(year, F.lit(1), F.lit(1)))
    )


def months_back(as_of: str | Column, n: int) -> Column:
    return F.add_months(_c(as_of), -n)

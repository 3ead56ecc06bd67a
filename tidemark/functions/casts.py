"""Guarded casts and text helpers for the bronze -> silver step (PRJ1-PRJ5, STD2-STD4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schemas import DECIMAL, NULL_TOKENS


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def null_token(x: str | Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """NULL when the lower-cased text is one of ``tokens`` (incl. the empty string)."""
    s = _c(x).cast("string")
    return F.when(F.lower(s).isin(list(tokens)), F.lit(None).cast("string")).otherwise(s)


def num(x: str | Column, tokens: Sequence[str] = NULL_TOKENS, dtype=DECIMAL) -> Column:
    """Guarded numeric cast (PRJ1).  Unparseable text becomes NULL (try_cast)."""
    return null_token(x, tokens).try_cast(dtype)


def day(x: str | Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Guarded date cast (PRJ2/PRJ3)."""
    return null_token(x, tokens).try_cast("date")


def stamp(x: str | Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return null_token(x, tokens).try_cast("timestamp")


def integer(x: str | Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return null_token(x, tokens).try_cast("int")


def text(x: str | Column, n: int | None = None) -> Column:
    """String with the silver length limit (PRJ5 / D22: VARCHAR(n) truncates)."""
    s = _c(x).cast("string")
    return F.substring(s, 1, n) if n else s


def first_valid(*cols: str | Column) -> Column:
    """PRJ4: first non-NULL of the guarded values."""
    return F.coalesce(*[_c(c) for c in cols])


def typed(x: str | Column, code: str, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Cast by feed type code (see ``tidemark.schemas``)."""
    if code.startswith("S"):
        return text(x, int(code[1:]) if len(code) > 1 else None)
    return {"N": num, "D": day, "T": stamp, "I": integer}[code](x, tokens)


def stringify(x: str | Column) -> Column:
    """STD3: any value to text (NULL stays NULL)."""
    return _c(x).cast("string")


def truncate(x: str | Column, n: int = 16000) -> Column:
    """STD4: cap text length."""
    return F.substring(_c(x).cast("string"), 1, n)

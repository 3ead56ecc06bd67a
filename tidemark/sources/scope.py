"""Per-query sharing of inputs.

Inside one query the same source table and the same daily aggregate feed many
branches (prices, flows, statements, index ...).  Each branch prunes columns
differently, so Spark cannot reuse their exchanges on its own.  The scope keeps
one DataFrame per key for the current query: raw tables are resolved once, and
the small per-(key, day) aggregates are checkpointed once, so every branch
reads one materialization (one scan of the big table) from shared storage.

The catalog resets the scope when a query is built, so a query never sees data
materialized for an earlier one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tidemark.session import cut_lineage

_MEMO: dict[tuple, DataFrame] = {}
_PERSISTED: list[DataFrame] = []


def shared(key: tuple, build: Callable[[], DataFrame], materialize: bool = False) -> DataFrame:
    """One DataFrame per key for the current query.  ``materialize`` writes it
    once to the session's checkpoint folder (reliable checkpoint: lineage is cut,
    files live in shared storage and survive executor loss)."""
    if key not in _MEMO:
        df = build()
        if materialize:
            df = cut_lineage(df)
            _PERSISTED.append(df)
        _MEMO[key] = df
    return _MEMO[key]


def reset() -> None:
    """Forget shared inputs and release persisted aggregates of the last query."""
    for df in _PERSISTED:
        try:
            df.unpersist(blocking=False)
        except Exception:  # noqa: BLE001 - session already stopped
            pass
    _PERSISTED.clear()
    _MEMO.clear()

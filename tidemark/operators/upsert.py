"""MERGE-style upsert for plain Parquet tables (SNK7-SNK9).

Built-in Parquet tables have no MERGE, so the merge is a full outer join on
the unique key with a per-column choice: matched rows take the new values
except ``keep_from_old`` (the created_* audit columns), unmatched rows pass
through from whichever side has them.

For large tables only the partitions the new batch touches are merged and
rewritten (dynamic partition overwrite), so a daily batch never reshuffles the
whole history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import CREATED_COLUMNS
from tidemark.session import small_side

_OLD, _NEW = "__in_old", "__in_new"


def reject_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """NULL keys never match in MERGE semantics; keep them out of the merge."""
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str],
           keep_from_old: Sequence[str] = CREATED_COLUMNS) -> DataFrame:
    keys = list(keys)
    cols = [c for c in new.columns]
    o = old.select(*keys, *[F.col(c).alias(f"o__{c}") for c in cols if c not in keys], F.lit(True).alias(_OLD))
    n = reject_null_keys(new, keys).select(
        *keys, *[F.col(c).alias(f"n__{c}") for c in cols if c not in keys], F.lit(True).alias(_NEW))
    j = o.join(n, keys, "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in keep_from_old:
            out.append(F.when(F.col(_OLD), F.col(f"o__{c}")).otherwise(F.col(f"n__{c}")).alias(c))
        else:
            out.append(F.when(F.col(_NEW), F.col(f"n__{c}")).otherwise(F.col(f"o__{c}")).alias(c))
    return j.select(*out)


def touched_partitions(old: DataFrame, new: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows of ``old`` in partitions the new batch writes to (semi join on the
    batch's distinct partition values, broadcast behind a size check)."""
    parts = new.select(*partition_cols).distinct()
    return old.join(small_side(parts), list(partition_cols), "left_semi")


def upsert_partitions(old: DataFrame, new: DataFrame, keys: Sequence[str], partition_cols: Sequence[str],
                      keep_from_old: Sequence[str] = CREATED_COLUMNS) -> DataFrame:
    """Merge result for the touched partitions only; write it with
    ``partitionOverwriteMode=dynamic`` so the other partitions stay as they are.
    ``partition_cols`` must be part of ``keys`` (a key never moves partition)."""
    return upsert(touched_partitions(old, new, partition_cols), new, keys, keep_from_old)


def write_upsert(result: DataFrame, path: str, partition_cols: Sequence[str] | None = None) -> None:
    """Persist a merge result.  Partitioned tables: dynamic overwrite of the
    touched partitions in place (Spark writes to a staging dir and swaps the
    partitions at commit).  Unpartitioned: the caller writes to a new version
    directory, because overwriting the path being read destroys the input."""
    w = result.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(path)


def build(new: DataFrame, *, full_refresh: bool = False, empty: bool = False, old: DataFrame | None = None,
          keys: Sequence[str] = ()) -> DataFrame:
    """SNK8/SNK9: full-refresh builds skip the merge; ``empty`` gives the schema with zero rows."""
    if empty:
        return new.limit(0)
    if full_refresh or old is None:
        return new
    return upsert(old, new, keys)

"""Run registered queries in Spark and their SQL oracle in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
Prints one line per query: rows, column match, value mismatches.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402

from tidemark.sources.tables import DRIVER_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits: int):
    if v is None:
        return None
    if isinstance(v, np.generic):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.{digits}g}")
    if v is pd.NaT:
        return None
    if hasattr(v, "isoformat"):
        return str(v)[:10] if len(str(v)) <= 10 or str(v).endswith("00:00:00") else str(v)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x, digits) for x in v.tolist())
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    if isinstance(v, int):
        return int(v)
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def rows_of(pdf: pd.DataFrame, digits: int) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v, digits) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, con, name: str, fn, sql: str | None, sf_dir: str, digits: int = 9) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    res = {"name": name, "rows": len(spdf), "spark_s": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    opdf = con.execute(sql).df()
    res["oracle_rows"] = len(opdf)
    res["cols_ok"] = sorted(spdf.columns) == sorted(opdf.columns)
    if not res["cols_ok"]:
        res["spark_cols"] = sorted(spdf.columns)
        res["oracle_cols"] = sorted(opdf.columns)
        return res
    a, b = rows_of(spdf, digits), rows_of(opdf, digits)
    sa, sb = set(a), set(b)
    res["only_spark"] = len([r for r in a if r not in sb])
    res["only_oracle"] = len([r for r in b if r not in sa])
    if res["only_spark"]:
        res["example_spark"] = [r for r in a if r not in sb][:2]
        res["example_oracle"] = [r for r in b if r not in sa][:2]
    res["ok"] = res["only_spark"] == 0 and res["only_oracle"] == 0 and len(a) == len(b)
    return res


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    from tidemark.plans.catalog import ORACLE, QUERIES, load_all
    from tidemark.session import get_session

    load_all()
    spark = get_session()
    con = duck(sf_dir)
    for name in names or list(QUERIES):
        try:
            r = compare(spark, con, name, QUERIES[name], ORACLE.get(name), sf_dir,
                        digits=int(__import__("os").environ.get("ORACLE_DIGITS", "9")))
        except Exception as e:  # noqa: BLE001
            r = {"name": name, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        print(r, flush=True)


if __name__ == "__main__":
    main()

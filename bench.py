"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set), BENCH_RUNS (default 2;
the fastest warm run is reported).  Each query is executed in full with the
``noop`` sink (no collect).  Shuffle bytes per query come from Spark's event
log written to a fresh scratch folder; exchanges are counted in the final plan.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "fact_table", "momentum_mart", "flows_mart", "macro_mart", "sentiment_mart", "fundamentals_mart",
    "fundamentals_asof", "price_indicators", "forward_labels", "sample_windows", "silver_stock_price",
    "upsert_keep_created", "statement_pivot", "gap_report", "strip_and_drop_lines", "auto_cutoffs",
]


def _shuffle_bytes(log_dir: str) -> dict[str, int]:
    stage_to_q: dict[int, str] = {}
    out: dict[str, int] = defaultdict(int)
    for f in glob.glob(os.path.join(log_dir, "*")) + glob.glob(os.path.join(log_dir, "eventlog*", "*")):
        if os.path.isdir(f) or f.endswith(".inprogress.tmp"):
            continue
        with open(f, encoding="utf-8", errors="replace") as fh:
            for line in fh:
                if '"SparkListenerJobStart"' in line:
                    ev = json.loads(line)
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    if desc:
                        for s in ev.get("Stage IDs", []):
                            stage_to_q[s] = desc
                elif '"SparkListenerTaskEnd"' in line:
                    ev = json.loads(line)
                    q = stage_to_q.get(ev.get("Stage ID"))
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    if q:
                        out[q] += int(m.get("Shuffle Bytes Written", 0))
    return dict(out)


def _final_exchanges(log_dir: str) -> dict[str, int]:
    """Exchanges of the last adaptive plan of each query's write, reused ones not counted."""
    of: dict[int, str] = {}
    plans: dict[int, dict] = {}
    for f in glob.glob(os.path.join(log_dir, "*")):
        if os.path.isdir(f):
            continue
        with open(f, encoding="utf-8", errors="replace") as fh:
            for line in fh:
                if "SparkListenerSQLExecutionStart" in line or "SparkListenerSQLAdaptiveExecutionUpdate" in line:
                    ev = json.loads(line)
                    if ev.get("description"):
                        of[ev["executionId"]] = ev["description"]
                    plans[ev["executionId"]] = ev["sparkPlanInfo"]

    def count(node: dict) -> int:
        if node["nodeName"].startswith("ReusedExchange"):
            return 0
        return int(node["nodeName"] in ("Exchange", "BroadcastExchange")) + sum(map(count, node["children"]))

    out: dict[str, int] = defaultdict(int)
    for k, plan in plans.items():
        if k in of:
            out[of[k]] += count(plan)
    return dict(out)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    scratch = tempfile.mkdtemp(prefix="tidemark-bench-", dir="/tmp")
    os.environ.setdefault("TIDEMARK_DRIVER_MEM", "16g")

    from pyspark.sql import SparkSession

    from tidemark.plans.catalog import QUERIES, load_all
    from tidemark.session import ENGINE_CONF, ensure_checkpoint_dir

    b = (SparkSession.builder.master(f"local[{cpus}]").appName("tidemark-bench")
         .config("spark.sql.shuffle.partitions", str(int(cpus) * 2))
         .config("spark.driver.memory", os.environ["TIDEMARK_DRIVER_MEM"])
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", scratch)
         .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
         .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt")))
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    load_all()

    times: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        best = None
        try:
            for r in range(runs):
                spark.sparkContext.setJobDescription(name if r == runs - 1 else f"{name}#warmup")
                t0 = time.perf_counter()
                df = QUERIES[name](spark, sf_dir)
                df.write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            times[name] = round(best, 3)
        except Exception as e:  # noqa: BLE001
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"
    spark.sparkContext.setJobDescription(None)
    spark.stop()
    shuffle = {k: v for k, v in _shuffle_bytes(scratch).items() if "#warmup" not in k}
    exchanges = {k: v for k, v in _final_exchanges(scratch).items() if k in times}
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_total_warm_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf.group(1)) if sf else sf_dir, "cpus": int(cpus),
        "shuffle_bytes": shuffle, "exchanges": exchanges,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()

"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set).  Each query runs to
completion through the ``noop`` sink (the full plan executes, nothing is
collected); the two written stages of the run (ingest, allocate) are timed first and
reported as their own entries; the queries after them read those stages,
as dashboard and report queries read the nightly marts.  Before timing,
every query runs once untimed on BENCH_WARMUP_DIR (default sf0.01) so the
JVM's JIT and Spark's codegen caches are warm.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerflow.catalog import QUERIES, RUN_DATE  # noqa: E402
from ledgerflow.plans.pipeline import TradingModel  # noqa: E402
from ledgerflow.session import local_session  # noqa: E402

HEADLINE = [
    "stg_transaction_log", "items_enriched", "mart_transactions", "daily_metrics", "vendor_balance",
    "customer_balance", "product_summary", "metrics_kpi_grid", "metrics_by_dim", "metrics_compare",
    "balance_as_of", "daily_digest", "reconcile_kpis", "dq_not_null",
    "row_fingerprint", "soft_delete", "rate_status3", "fact_inventory", "ar_balance", "metrics_catalog",
    "dq_violations", "quarantine", "dq_summary", "asof_events", "dq_duplicates",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2, app="ledgerflow-bench")
    spark.range(1000).selectExpr("sum(id)").collect()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")
    if warm_dir and os.path.isdir(warm_dir) and warm_dir != sf_dir:
        # Untimed pass over a small scale factor: JIT and whole-stage codegen caches get hot, as in a
        # long-running service; the timed numbers below are then steady-state per query.
        TradingModel.staged(spark, warm_dir, RUN_DATE).allocated  # noqa: B018 - writes the stage
        for n in names:
            run(QUERIES[n](spark, warm_dir))
    times: dict[str, float] = {}
    # The run's two written stages, timed on their own (every later query reads them):
    # ingest = driver tables -> three raw tabs; allocate = as-of valuation + payment allocation.
    t0 = time.perf_counter()
    m = TradingModel.staged(spark, sf_dir, RUN_DATE)
    times["ingest"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    m.allocated  # noqa: B018 - writes the allocated-lines stage
    times["allocate"] = round(time.perf_counter() - t0, 3)
    for n in names:
        t0 = time.perf_counter()
        run(QUERIES[n](spark, sf_dir))
        times[n] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "warmup_dir": warm_dir if warm_dir != sf_dir else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""The nightly run: guard -> ingest -> parity -> transform -> marts -> state.

``python -m ledgerflow --tabs DIR --out ROOT [--run-date YYYY-MM-DD] [--force]``
reads the three tab exports (``transaction_log``, ``vendor_rates``,
``customer_rates`` as CSV, JSON lines or parquet), compares the digests of their
hash buckets with the stored state, reloads the changed buckets of the raw
tables (all of them on the first run, or when forced), checks load parity,
rebuilds every mart, and records the digests and a run record last.  Every run, good or
failed, adds its times to the run history, which ``run_kpis`` judges.  ``--driver-sf DIR`` uses the driver tables through the fixture mapping instead of tab exports.

The only values brought to the driver are the digests of at most 64 buckets
per table, needed for the go / no-go decisions.
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import config
from ledgerflow.plans import kpis, pipeline
from ledgerflow.sources import fixtures, state, tabs

RUN_RECORD = "started_at timestamp_ntz, finished_at timestamp_ntz, ok boolean"


def read_exports(spark: SparkSession, tabs_dir: str) -> dict[str, DataFrame]:
    out = {}
    for name, cmap in config.TAB_COLUMN_MAPS.items():
        for fmt in ("csv", "json", "parquet"):
            try:  # Spark looks: exports may lie in any store that it reads
                out[name] = tabs.read_tab_export(spark, f"{tabs_dir}/{name}.{fmt}", cmap, fmt, name)
                break
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
        else:
            raise FileNotFoundError(f"no export for tab '{name}' in {tabs_dir}")
    return out


def daily_run(spark: SparkSession, source: dict[str, DataFrame], out_root: str, run_date: _dt.date,
              force: bool = False) -> dict:
    """One nightly run (``_run``), with its times and outcome added to ``state/runs`` whether it ends well or not."""
    started, ok = _utc_now(), False
    try:
        result = _run(spark, source, out_root, run_date, force)
        ok = True
        return result
    finally:
        spark.createDataFrame([(started, _utc_now(), ok)], RUN_RECORD).write.mode("append").parquet(f"{out_root}/state/runs")


def run_kpis(spark: SparkSession, out_root: str) -> DataFrame:
    """Run time, monthly success rate and failures in a row of the recorded runs against their bounds."""
    return kpis.judge(spark, kpis.per_run(spark.read.schema(RUN_RECORD).parquet(f"{out_root}/state/runs")))


def _utc_now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _run(spark: SparkSession, source: dict[str, DataFrame], out_root: str, run_date: _dt.date, force: bool) -> dict:
    """``source``: the tabs as read (blank rows and all).

    The digests of the stored state name the buckets whose content changed, by counts
    or by an edit in place; those buckets of the raw tables are written anew, the
    others are not touched.
    """
    state_path, raw_root = f"{out_root}/state/ingest_digests", f"{out_root}/raw"
    kept = {name: tabs.clean_cells(df) for name, df in source.items()}
    current = state.table_digests(kept, tabs.ROW_KEYS).cache()  # a row per bucket
    try:
        previous = state.load_state(spark, state_path).select(*current.columns).cache()
        first = False
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        previous, first = spark.createDataFrame([], current.schema), True  # no state yet
    moved = state.content_delta(previous, current).collect()  # a few rows per table
    stale: dict[str, list[int]] = {}
    for r in moved:
        stale.setdefault(r.table_name, []).append(r.bucket)
    counts = {r.table_name: int(r.row_count) for r in current.groupBy("table_name").agg(F.sum("n").alias("row_count")).collect()}
    counts = {name: counts.get(name, 0) for name in source}
    before = {r.table_name: int(r.row_count) for r in previous.groupBy("table_name").agg(F.sum("n").alias("row_count")).collect()}
    delta = {name: counts[name] - before.get(name, 0) for name in source if name in stale or first}
    skipped = not (force or stale or first)
    live: dict[str, list[int]] = {name: [] for name in source}
    for r in current.select("table_name", "bucket").collect():
        live[r.table_name].append(r.bucket)
    columns = {name: list(dict.fromkeys(config.TAB_COLUMN_MAPS[name].values())) for name in config.TAB_COLUMN_MAPS}
    metrics = {}
    if not skipped:
        for name, df in source.items():
            only = None if force or first else stale.get(name, [])
            if only is None or only:
                metrics[name] = tabs.load_tab(df, name, f"{raw_root}/{name}", only)
        written = {name: tabs.loaded(spark, f"{raw_root}/{name}", columns[name], live=live[name]) for name in source}
        bad = state.content_delta(current, state.table_digests(written, tabs.ROW_KEYS)).collect()
        if bad:
            raise RuntimeError(f"load parity failed: {[r.asDict() for r in bad]}")
    raw = {name: tabs.loaded(spark, f"{raw_root}/{name}", columns[name], live=live[name]) for name in config.TAB_COLUMN_MAPS}
    paths = pipeline.run(spark, pipeline.TradingModel(raw, run_date), out_root)
    if not skipped:
        rows = current.collect()
        state.save_state(spark.createDataFrame(rows, current.schema), state_path)
    finished = _utc_now()
    record = spark.createDataFrame(
        [(finished, skipped, counts, delta or None, {n: len(b) for n, b in stale.items()} or None)],
        "finished_at timestamp, skipped boolean, row_counts map<string,bigint>, row_delta map<string,bigint>, changed_buckets map<string,int>")
    record.write.mode("overwrite").json(f"{out_root}/state/last_ingest_run")
    current.unpersist()
    return {"skipped": skipped, "row_delta": delta, "changed_buckets": stale, "load": metrics, "marts": paths}


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="ledgerflow", description="nightly ELT run")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tabs", help="folder with the three tab exports")
    src.add_argument("--driver-sf", help="driver table folder (fixture mapping)")
    ap.add_argument("--out", required=True, help="warehouse root (a shared path on a cluster)")
    ap.add_argument("--run-date", default=None, help="business 'today' (default: today)")
    ap.add_argument("--force", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.config("spark.ui.enabled", "false").getOrCreate()
    run_date = _dt.date.fromisoformat(a.run_date) if a.run_date else _dt.date.today()
    if a.tabs:
        source = read_exports(spark, a.tabs)
    else:
        source = fixtures.raw_tabs(spark, a.driver_sf)
    result = daily_run(spark, source, a.out, run_date, a.force)
    print({k: v for k, v in result.items() if k != "marts"})

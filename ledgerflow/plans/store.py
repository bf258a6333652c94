"""Written stage tables: cut lineage at the boundaries the nightly run has anyway.

``stage(spark, key, build)`` writes ``build()`` once per session under the
shared scratch folder (next to ``spark.checkpoint.dir``) and returns a
DataFrame that reads it back.  A lost executor then recomputes from the last
written stage instead of from the raw scans, and later queries of the same
run (marts, metrics, reports) start from the written table instead of
re-deriving it - the same materialisation boundary as the reference's
``table`` models.  Keys must name everything the stage depends on.
"""

from __future__ import annotations

import gc
import hashlib
import threading
import time
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerflow.operators.buckets import drop
from ledgerflow.session import scratch_root

_WRITTEN: dict[tuple[str, str], str] = {}
_LOCKS: dict[tuple[str, str], threading.Lock] = {}
_SCHEMAS: dict[str, StructType] = {}
_GUARD = threading.Lock()
_RUN_ID = uuid.uuid4().hex[:12]
#: Jobs that took longer leave enough behind to look for it.
FREE_AFTER_S = 5


def _sid(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def stage(spark: SparkSession, key: str, build, partition_by: list[str] | None = None) -> DataFrame:
    def write(path: str) -> None:
        df = build()
        _SCHEMAS[path] = df.schema
        w = df.write.mode("overwrite").option("compression", "zstd")  # hashes in hex take half of the space
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)

    path = written(spark, key, write)
    return spark.read.schema(_SCHEMAS[path]).parquet(path)  # a partitioned table may be empty


def written(spark: SparkSession, key: str, write) -> str:
    """The folder that ``write(path)`` fills, once per session and key."""
    sid = _sid(spark)
    with _GUARD:
        lock = _LOCKS.setdefault((sid, key), threading.Lock())
    with lock:  # concurrent callers of one stage wait for the single writer
        hit = _WRITTEN.get((sid, key))
        if hit is None:
            digest = hashlib.sha1(key.encode()).hexdigest()[:16]
            hit = f"{scratch_root(spark)}/run-{_RUN_ID}/{digest}"
            began = time.monotonic()
            write(hit)
            free(spark, time.monotonic() - began)
            _WRITTEN[(sid, key)] = hit
    return hit


def free(spark: SparkSession, seconds: float = FREE_AFTER_S) -> None:
    """Let Spark delete the shuffle files of a finished job that took ``seconds``.

    It does so when the driver collects its garbage, which may be long after the
    job: till then the files of every stage lie on the disk together.
    """
    if seconds >= FREE_AFTER_S:
        for _ in range(2):  # the first collects what still names the job: its events, and Python's references
            gc.collect()
            spark.sparkContext._jvm.System.gc()
            time.sleep(0.5)


@contextmanager
def passing(spark: SparkSession, key: str):
    """``stage(name, build)`` for what only the work inside reads: written like a stage, deleted at the end."""
    root = f"{scratch_root(spark)}/run-{_RUN_ID}/passing-{hashlib.sha1(key.encode()).hexdigest()[:16]}-{uuid.uuid4().hex[:8]}"

    def stage(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        df, began = build(), time.monotonic()
        df.write.option("compression", "zstd").parquet(f"{root}/{name}")
        free(spark, time.monotonic() - began)
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    try:
        yield stage
    finally:
        drop(spark, root)


def forget(spark: SparkSession | None = None) -> None:
    """Drop the session's registry (the files stay until the run folder is cleaned)."""
    if spark is None:
        _WRITTEN.clear()
        return
    sid = _sid(spark)
    for k in [k for k in _WRITTEN if k[0] == sid]:
        del _WRITTEN[k]


def in_parallel(thunks, max_workers: int = 4) -> list:
    """Run independent Spark actions (stage writes) as concurrent jobs; results in input order.

    The scheduler then fills the cluster with tasks of several jobs at once
    instead of running small jobs back to back (the reference's transform step
    runs its independent models on four threads the same way).
    """
    from concurrent.futures import ThreadPoolExecutor
    thunks = list(thunks)
    if len(thunks) <= 1:
        return [t() for t in thunks]
    with ThreadPoolExecutor(max_workers=min(max_workers, len(thunks))) as pool:
        return [f.result() for f in [pool.submit(t) for t in thunks]]

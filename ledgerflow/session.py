"""Session helpers.

On a cluster the session comes from the launcher; ``local_session`` is for
tests, the bench and the driver checks.  Settings every run relies on:

* AQE on (runtime coalescing, skew-join splitting, runtime broadcast only
  when the measured side is under ``autoBroadcastJoinThreshold``);
* session time zone UTC: all timestamps are naive business times;
* ANSI on (Spark's default): every tolerant parse uses ``try_*``.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerflow") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = {
        **SCALE_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("LEDGERFLOW_DRIVER_MEMORY", "16g"),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's ``spark.checkpoint.dir``.

    A scratch folder is made only where the setting is unset and Spark runs in
    one process (tests, the bench); on a cluster every executor would write to
    its own disk, so a missing setting is an error there.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables: next to the checkpoint dir."""
    return ensure_checkpoint_dir(spark).rstrip("/") + "/tables"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, for the few scans that run Python in tasks; once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{package.name}-sources-"), f"{package.name}-sources.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)

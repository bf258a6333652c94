"""Content-based row identity, snapshot diff and soft delete.

* ``with_source_row_id``: ``{sheet}:{tab}:{sha256(json(sorted business columns))[:16]}``;
  rows whose fingerprint occurs more than once in the same load get
  ``:row{source_row_number}`` appended.  Fingerprint counts come from a
  partial-aggregated ``groupBy``, of which only those above one are joined
  back (no window over a group of copies, so a huge group of identical rows is
  not funnelled into one task).  With ``stage`` the hashed rows and the repeated
  fingerprints are written first: a row is hashed once, and as the repeated ones
  are a small table unless the log is full of copies, no row is shuffled for them.
* ``snapshot_diff``: previous vs current id sets in one full outer join.
* ``apply_soft_delete``: the lifecycle state after a load - missing ids are
  soft-deleted, returning ids are reactivated, new ids are inserted.  Plain
  parquet has no MERGE, so the new state is a full rewrite (join + overwrite).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.expr import naive_ts


def fingerprint(cols: Sequence[str], names: Sequence[str] | None = None) -> F.Column:
    """sha-256 hex of the JSON object of the columns, keys sorted (NULL cells as '')."""
    names = list(names or cols)
    pairs = sorted(zip(names, cols))
    obj = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in pairs])
    return F.sha2(F.to_json(obj), 256)


def with_source_row_id(df: DataFrame, sheet_id: str, tab: str, cols: Sequence[str],
                       row_number_col: str = "source_row_number", names: Sequence[str] | None = None,
                       stage: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None) -> DataFrame:
    """``stage(name, build)`` (optional) writes what ``build`` gives and reads it back."""
    stage = stage or (lambda name, build: build())
    fp = stage("fingerprinted", lambda: df.withColumn("content_fingerprint", fingerprint(cols, names)))
    return assign_source_row_id(fp, sheet_id, tab, row_number_col, stage)


def assign_source_row_id(fp: DataFrame, sheet_id: str, tab: str,
                         row_number_col: str = "source_row_number",
                         stage: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None) -> DataFrame:
    """Ids for one load of fingerprinted rows (the collision suffix depends on the load's own copies).

    A subset of an already fingerprinted table is re-identified without hashing again.
    """
    fp = fp.drop("source_row_id").withColumn("__short", F.substring("content_fingerprint", 1, 16))
    stage = stage or (lambda name, build: build())
    counts = stage("copies", lambda: fp.groupBy("__short").agg(F.count(F.lit(1)).alias("__copies")).where("__copies > 1"))  # two contents can share the short form
    j = fp.join(counts, "__short", "left")
    base = F.concat_ws(":", F.lit(sheet_id), F.lit(tab), F.col("__short"))
    rid = F.when(F.col("__copies") > 1, F.concat(base, F.lit(":row"), F.col(row_number_col).cast("string"))) \
        .otherwise(base)
    return j.withColumn("source_row_id", rid).drop("__copies", "__short")


def lone_and_repeated(identified: DataFrame, sheet_id: str, tab: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose fingerprint no other row shares, and the others.

    A lone row has the same id in every subset of the rows; ids of the others depend on the subset.
    """
    base = F.concat_ws(":", F.lit(sheet_id), F.lit(tab), F.substring("content_fingerprint", 1, 16))
    lone = F.coalesce(F.col("source_row_id") == base, F.lit(False))
    return identified.where(lone), identified.where(~lone)


def snapshot_diff(previous: DataFrame, current: DataFrame, key: str = "source_row_id") -> DataFrame:
    """(key, status) with status new / deleted / kept."""
    p = previous.select(F.col(key), F.lit(True).alias("__p")).distinct()
    c = current.select(F.col(key), F.lit(True).alias("__c")).distinct()
    j = p.join(c, key, "full")
    status = (F.when(F.col("__p").isNull(), F.lit("new"))
              .when(F.col("__c").isNull(), F.lit("deleted")).otherwise(F.lit("kept")))
    return j.select(key, status.alias("status"))


STATE_COLUMNS = ["source_row_id", "is_deleted", "deleted_at", "deletion_reason", "deleted_by_load_id",
                 "last_seen_load_id", "last_seen_at"]


def initial_state(ids: DataFrame, load_id: str, load_ts: _dt.datetime, key: str = "source_row_id") -> DataFrame:
    return ids.select(key).distinct().select(
        F.col(key).alias("source_row_id"), F.lit(False).alias("is_deleted"),
        F.lit(None).cast("timestamp_ntz").alias("deleted_at"), F.lit(None).cast("string").alias("deletion_reason"),
        F.lit(None).cast("string").alias("deleted_by_load_id"), F.lit(load_id).alias("last_seen_load_id"),
        naive_ts(load_ts).alias("last_seen_at"))


def apply_soft_delete(state: DataFrame, current_ids: DataFrame, load_id: str, load_ts: _dt.datetime,
                      key: str = "source_row_id") -> DataFrame:
    """New lifecycle state plus ``change``: inserted / reactivated / deleted / kept / still_deleted."""
    cur = current_ids.select(F.col(key).alias("source_row_id")).distinct().withColumn("__seen", F.lit(True))
    j = state.join(cur, "source_row_id", "full")
    seen = F.col("__seen").isNotNull()
    was_known = F.col("is_deleted").isNotNull()
    was_deleted = F.coalesce(F.col("is_deleted"), F.lit(False))
    ts = naive_ts(load_ts)
    change = (F.when(seen & ~was_known, F.lit("inserted"))
              .when(seen & was_deleted, F.lit("reactivated"))
              .when(seen, F.lit("kept"))
              .when(was_deleted, F.lit("still_deleted"))
              .otherwise(F.lit("deleted")))
    newly_deleted = ~seen & ~was_deleted
    return j.select(
        "source_row_id",
        F.when(seen, F.lit(False)).otherwise(F.lit(True)).alias("is_deleted"),
        F.when(seen, F.lit(None).cast("timestamp_ntz")).when(newly_deleted, ts).otherwise(F.col("deleted_at"))
        .alias("deleted_at"),
        F.when(seen, F.lit(None).cast("string")).when(newly_deleted, F.lit("source_removed"))
        .otherwise(F.col("deletion_reason")).alias("deletion_reason"),
        F.when(seen, F.lit(None).cast("string")).when(newly_deleted, F.lit(load_id))
        .otherwise(F.col("deleted_by_load_id")).alias("deleted_by_load_id"),
        F.when(seen, F.lit(load_id)).otherwise(F.col("last_seen_load_id")).alias("last_seen_load_id"),
        F.when(seen, ts).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        change.alias("change"),
    )


def active(df: DataFrame, flag: str = "is_deleted") -> DataFrame:
    """``coalesce(is_deleted, false) = false``."""
    return df.where(~F.coalesce(F.col(flag), F.lit(False)))

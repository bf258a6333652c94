"""Joins of a long table with one compact row set per key, when single keys may hold a third of the long table.

``heavy_keys`` finds such keys by counting hash buckets first (a few thousand numbers,
whatever the table) and keys only inside suspicious buckets.  A key is heavy if it holds
more rows than a shuffle partition's even share, so there are fewer heavy keys than
shuffle partitions.

``split_join`` joins the rows of heavy keys to a broadcast of the compact side's rows for
those keys: they are not shuffled, each stays in the task that read it.  All other keys
take a plain join, where no partition can outgrow the others by a single key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fewer rows than this are no burden for one task.
MIN_ROWS = 100_000


def heavy_keys(df: DataFrame, key: str, min_rows: int = MIN_ROWS) -> list:
    """Keys (never NULL) with more rows than ``min_rows`` and than an even share of the shuffle partitions."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4096, 16 * partitions)
    keyed = df.where(F.col(key).isNotNull()).select(key)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    counts = {r.b: r.n for r in keyed.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()}
    limit = max(min_rows, sum(counts.values()) // partitions)
    suspects = [b for b, n in counts.items() if n > limit]
    if not suspects:
        return []
    found = keyed.where(bucket.isin(suspects)).groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > limit)
    return sorted(r[key] for r in found.collect())  # fewer than the partitions


def is_heavy(key: str, heavy: Sequence) -> Column:
    return F.coalesce(F.col(key).isin(list(heavy)), F.lit(False))


def split(df: DataFrame, key: str, heavy: Sequence) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of heavy keys)."""
    if not heavy:
        return df, None
    return df.where(~is_heavy(key, heavy)), df.where(is_heavy(key, heavy))


def small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """``df`` marked for broadcast if a count proves it small; beyond that the join is Spark's choice (AQE splits its skew)."""
    return F.broadcast(df) if df.count() <= max_rows else df


def split_join(left: DataFrame, right: DataFrame, key: str, heavy: Sequence, how: str = "left") -> DataFrame:
    """``left.join(right, key, how)`` (left or inner); ``right`` holds few rows of any key."""
    plain, hot = split(left, key, heavy)
    few, few_hot = split(right, key, heavy)
    out = plain.join(few, key, how)
    return out if hot is None else out.unionByName(hot.join(F.broadcast(few_hot), key, how))

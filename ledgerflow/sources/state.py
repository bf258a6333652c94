"""Load bookkeeping: row-count parity, change guards by count and by content, run state.

All of it is a handful of small aggregates joined together; no counts are
pulled to the driver to be compared in Python.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators import buckets


def row_counts(tabs: Mapping[str, DataFrame], column: str = "row_count") -> DataFrame:
    """One row per table: (table_name, count). Each count is a partial-aggregated global count."""
    parts = [df.agg(F.count(F.lit(1)).alias(column)).select(F.lit(name).alias("table_name"), column)
             for name, df in tabs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_count_parity(source: Mapping[str, DataFrame], loaded: Mapping[str, DataFrame]) -> DataFrame:
    """Source vs loaded count per table with an ``ok`` flag (S8)."""
    s = row_counts(source, "source_rows")
    t = row_counts(loaded, "loaded_rows")
    return (s.join(t, "table_name", "full")
            .select("table_name",
                    F.coalesce("source_rows", F.lit(0)).alias("source_rows"),
                    F.coalesce("loaded_rows", F.lit(0)).alias("loaded_rows"))
            .withColumn("ok", F.col("source_rows") == F.col("loaded_rows")))


def row_count_delta(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Changed tables only: (table_name, previous_rows, current_rows, row_delta) (S9, S10).

    ``previous`` and ``current`` are (table_name, row_count) frames; a table
    absent from the previous state is a first load and reports its full count.
    """
    p = previous.select("table_name", F.col("row_count").alias("previous_rows"))
    c = current.select("table_name", F.col("row_count").alias("current_rows"))
    j = p.join(c, "table_name", "full")
    delta = F.coalesce("current_rows", F.lit(0)) - F.coalesce("previous_rows", F.lit(0))
    return (j.select("table_name", "previous_rows", "current_rows", delta.alias("row_delta"))
            .where(F.col("previous_rows").isNull() | (F.col("row_delta") != 0)))


def should_run(previous: DataFrame, current: DataFrame, force: bool = False) -> DataFrame:
    """One row: run = forced, first run, or any count changed (the guard decision)."""
    d = row_count_delta(previous, current)
    return d.agg((F.lit(force) | (F.count(F.lit(1)) > 0)).alias("run"))


def table_digests(tabs: Mapping[str, DataFrame], keys: Mapping[str, list[str]]) -> DataFrame:
    """(table_name, bucket, n, hash_sum, hash_xor): order-free digests of every table's buckets."""
    parts = [buckets.digests(df, keys[name]).select(F.lit(name).alias("table_name"), "*") for name, df in tabs.items()]
    return reduce(DataFrame.unionByName, parts)


def content_delta(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(table_name, bucket, previous_rows, current_rows) of the buckets whose content changed, edits in place included (S9)."""
    value = F.struct("n", "hash_sum", "hash_xor")
    p = previous.select("table_name", "bucket", value.alias("p"))
    c = current.select("table_name", "bucket", value.alias("c"))
    zero = F.lit(0).cast("long")
    return p.join(c, ["table_name", "bucket"], "full").where(~F.col("p").eqNullSafe(F.col("c"))).select(
        "table_name", "bucket", F.coalesce("p.n", zero).alias("previous_rows"), F.coalesce("c.n", zero).alias("current_rows"))


def save_state(counts: DataFrame, path: str) -> None:
    """Persist counts last, after a successful load (S11)."""
    counts.withColumn("run_ts", F.current_timestamp()).write.mode("overwrite").parquet(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("run_ts")

"""Data-quality tests as queries that return failing rows (or failure counts).

Column tests of one table are evaluated in a single aggregation pass
(conditional counts), then unpivoted to one row per (table, column, test).
Uniqueness tests are a partial-aggregated ``groupBy().count()`` filtered to
``count > 1``.  Nothing is pulled to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _long(agg: DataFrame, model: str, test: str, cols: Sequence[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("failures")) for c in cols])
    return agg.select(F.lit(model).alias("model_name"), F.lit(test).alias("test_name"), F.inline(rows))


def not_null_counts(df: DataFrame, model: str, cols: Sequence[str], weight: Column | None = None) -> DataFrame:
    """(model_name, test_name, column_name, failures) with failures = NULL count per column.

    ``weight``: how many rows of the tested model a row of ``df`` stands for.
    """
    one = F.lit(1) if weight is None else weight
    agg = df.agg(*[F.coalesce(F.sum(F.when(F.col(c).isNull(), one)), F.lit(0)).cast("long").alias(c) for c in cols])
    return _long(agg, model, "not_null", cols)


def accepted_values_counts(df: DataFrame, model: str, rules: Mapping[str, Sequence[str]]) -> DataFrame:
    """Failures = rows whose value is not NULL and not in the accepted list."""
    agg = df.agg(*[F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(v))).alias(c) for c, v in rules.items()])
    return _long(agg, model, "accepted_values", list(rules))


def duplicate_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Key values occurring more than once, with their count ``n``."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

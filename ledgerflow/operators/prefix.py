"""Running sums in two levels, for keys that have too many rows for one window.

Rows are cut into blocks of their order column.  Block totals are one partial
aggregation; their running sum per key has one row per block.  Inside a (key, block) a
window adds up the block's own rows, and the sum of all earlier blocks is added to it.
No window spans the rows of a whole key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, keys: Sequence[str], order: str, block: Column, sums: Mapping[str, Column]) -> DataFrame:
    """``df`` plus, for each of ``sums``, the running sum of its expression by ``order`` within ``keys``.

    ``block`` rises with ``order`` (for instance its month); ``keys`` with ``order`` are unique.
    """
    rows = df.withColumns({"__block": block, **{f"__x_{n}": e for n, e in sums.items()}})
    totals = rows.groupBy(*keys, "__block").agg(*[F.sum(f"__x_{n}").alias(f"__s_{n}") for n in sums])
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(*keys, "__block", *[F.sum(f"__s_{n}").over(earlier).alias(f"__p_{n}") for n in sums])
    inside = Window.partitionBy(*keys, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.join(before, [*keys, "__block"])
    return joined.select(*df.columns, *[(F.coalesce(F.col(f"__p_{n}"), F.lit(0)) + F.sum(f"__x_{n}").over(inside)).alias(n) for n in sums])

"""Backward, inclusive as-of join (Spark has no native one).

``asof_join(left, right, on, left_date, right_date)`` attaches to every left
row the right row of the same key with the greatest ``right_date <= left_date``.

Plan (no pairs are ever materialised):

1. *Intervalise* the right side: ``valid_to = lead(right_date)`` per key, so
   each right row owns the half-open interval ``[right_date, valid_to)``.
   Rows that tie on ``right_date`` get empty intervals except the last one in
   the (date, tie-break) order, so the pick is deterministic.
2. *Bucket* the intervals by calendar quarter and explode each interval into
   the quarters it covers.  The open last interval is cut at the largest left
   date (one aggregate, evaluated once and passed as a literal).
3. *Equi-join* on ``(key, quarter)`` with the residual
   ``right_date <= left_date < valid_to``.  Intervals are disjoint, so every
   left row meets at most one interval: the output has exactly the left rows.

Why bucket: with a plain key join every left row would probe every rate row
of its counterparty.  With quarters in the join key a probe sees few
candidates, and a hot counterparty is spread over as many join partitions as
it has active quarters (AQE's skew-join split handles what is left).  Prices
that hold for weeks or months are then written out about once, where month
buckets repeated a quarterly price four times in the shuffle.  If the
right side is small at runtime, AQE turns the join into a broadcast hash
join on its own, after measuring it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.expr import naive_ts

BUCKET = "__asof_bucket"
VALID_TO = "__asof_valid_to"


def value_literal(v) -> Column:
    """Literal for a date / timestamp value read back from an aggregate (timestamps stay zone-free)."""
    if isinstance(v, _dt.datetime):
        return naive_ts(v)
    return F.lit(v)


def quarter_index(d: Column) -> Column:
    """Quarters since year 0 for a DATE or TIMESTAMP."""
    return F.year(d) * 4 + F.quarter(d) - 1


def intervalise(right: DataFrame, on: Sequence[str], right_date: str,
                tiebreak: Sequence[str] = ()) -> DataFrame:
    """Add ``__asof_valid_to`` = next ``right_date`` of the same key (NULL for the newest row)."""
    order = [F.col(right_date)] + [F.col(c).asc_nulls_first() for c in tiebreak]
    w = Window.partitionBy(*on).orderBy(*order)
    return right.withColumn(VALID_TO, F.lead(right_date).over(w))


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_date: str, right_date: str,
              how: str = "left", tiebreak: Sequence[str] = (), upper_bound: Column | None = None,
              stage: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None) -> DataFrame:
    """Backward inclusive as-of join; returns left columns + right columns (minus keys).

    ``on`` names the equi-key columns, present under the same names on both
    sides.  ``upper_bound`` (a DATE / TIMESTAMP column expression) caps the
    open last interval; by default it is ``max(left_date)``, computed once.
    ``stage(name, build)`` (optional) writes the intervals, so that their shuffle is over before the join's.
    """
    if upper_bound is None:
        # One small distributed aggregate, evaluated once; the value is a literal in the plan
        # (a scalar subquery referenced by several expressions may be evaluated several times).
        upper_bound = value_literal(left.agg(F.max(left_date)).first()[0])
    iv = intervalise(right, on, right_date, tiebreak)
    iv = iv if stage is None else stage("intervals", lambda: iv)
    lo = quarter_index(F.col(right_date))
    # The last day of a DATE interval is the one before valid_to.  With times the upper bucket may include
    # valid_to itself; the residual condition below is exact, so one bucket more only adds a candidate.
    last = F.date_sub(VALID_TO, 1) if right.schema[right_date].dataType.simpleString() == "date" else F.col(VALID_TO)
    hi = F.coalesce(quarter_index(last), quarter_index(upper_bound))
    # Empty intervals (ties) and intervals starting after the last left value cover no bucket.
    live = (F.col(right_date) < F.col(VALID_TO)) | (F.col(VALID_TO).isNull() & (F.col(right_date) <= upper_bound))
    buckets = F.when(live & (hi >= lo), F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))
    rb = iv.select("*", F.explode(buckets).alias(BUCKET))
    lb = left.withColumn(BUCKET, quarter_index(F.col(left_date)))
    r_alias = "__asof_r_"
    rb = rb.select([F.col(c).alias(r_alias + c) for c in rb.columns])
    cond = [lb[c] == rb[r_alias + c] for c in on + [BUCKET]]
    cond.append(rb[r_alias + right_date] <= lb[left_date])
    cond.append(rb[r_alias + VALID_TO].isNull() | (lb[left_date] < rb[r_alias + VALID_TO]))
    joined = lb.join(rb, cond, how)
    keep_right = [c for c in right.columns if c not in on]
    return joined.select(
        *[lb[c] for c in left.columns],
        *[rb[r_alias + c].alias(c) for c in keep_right if c not in left.columns],
    )


#: Time ranges of ``asof_ranges`` at most; a row finds its range by a tree of comparisons.
MAX_RANGES = 256


def equi_depth_borders(*times: DataFrame, ranges: int) -> list:
    """Ascending inner borders of about equally full time ranges, from one quantile sketch over single-column frames."""
    both = reduce(DataFrame.unionAll, times).toDF("t").where("t IS NOT NULL")
    kind = both.schema["t"].dataType.simpleString()
    micros = F.unix_micros(F.col("t").cast("timestamp")) if kind != "timestamp_ntz" else F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("t"))
    points = [i / ranges for i in range(1, ranges)]
    found = both.agg(F.percentile_approx(micros, points, 20 * ranges)).first()[0] if points else None
    return sorted(set(found or []))


def _range_of(micros: Column, borders: list[int], low: int = 0) -> Column:
    """How many borders are not above the value, by halving."""
    if not borders:
        return F.lit(low)
    mid = len(borders) // 2
    return F.when(micros < F.lit(borders[mid]), _range_of(micros, borders[:mid], low)).otherwise(_range_of(micros, borders[mid + 1:], low + mid + 1))


def asof_ranges(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, tiebreak: Sequence[str] = (), ranges: int | None = None) -> DataFrame:
    """Backward inclusive as-of left join on timestamps; returns left columns + right columns (minus keys).

    Time is cut into equi-depth ranges, so rows of one key spread over as many
    partitions as it has busy ranges, however narrow the time in which they lie.
    Inside a (key, range) both sides are sorted together and every left row takes
    the last right row before it.  Left rows before the range's first right row
    take the one carried over the border: the last right row of each (key, range)
    is found by one partial aggregation and handed on over the ranges of the key
    (at most ``ranges`` rows).
    """
    spark = left.sparkSession
    n = min(MAX_RANGES, ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    borders = equi_depth_borders(left.select(left_ts), right.select(right_ts), ranges=n)
    micros = lambda c, df: (F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(c))
                            if df.schema[c].dataType.simpleString() == "timestamp_ntz" else F.unix_micros(F.col(c).cast("timestamp")))
    taken = [c for c in right.columns if c not in on and c not in left.columns]
    row = F.struct(*[F.col(c) for c in right.columns if c not in on])
    own = F.struct(*[F.col(c) for c in left.columns])
    keys = [F.col(c) for c in on]
    order = F.struct(micros(right_ts, right).alias("t"), *[F.col(c).alias(f"b{i}") for i, c in enumerate(tiebreak)])
    timed = right.where(F.col(right_ts).isNotNull()).withColumn("__t", micros(right_ts, right))
    r = timed.select(*keys, _range_of(F.col("__t"), borders).alias("__range"), "__t", order.alias("__order"), row.alias("__row"))
    lt = left.withColumn("__t", micros(left_ts, left))
    l = lt.select(*keys, F.when(F.col("__t").isNull(), F.lit(-1)).otherwise(_range_of(F.col("__t"), borders)).alias("__range"), "__t", own.alias("__own"))
    # the last right row of every (key, range) that has any row, handed on to the key's next ranges
    last = r.groupBy(*on, "__range").agg(F.max_by("__row", "__order").alias("__row"))
    asked = l.groupBy(*on, "__range").agg(F.count("*").alias("__asked"))
    by_key = Window.partitionBy(*on).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    both = last.join(asked, [*on, "__range"], "full")
    carried = both.withColumn("__carry", F.last("__row", ignorenulls=True).over(by_key)).where(F.col("__asked").isNotNull() & F.col("__carry").isNotNull())
    none = lambda name, df: F.lit(None).cast(df.schema[name].dataType).alias(name)
    kinds = [
        carried.select(*on, "__range", F.lit(-1).alias("__kind"), F.lit(None).cast("long").alias("__t"), none("__order", r), F.col("__carry").alias("__row"), none("__own", l)),
        r.select(*on, "__range", F.lit(0).alias("__kind"), "__t", "__order", "__row", none("__own", l)),
        l.select(*on, "__range", F.lit(1).alias("__kind"), "__t", none("__order", r), none("__row", r), "__own")]
    line = Window.partitionBy(*on, "__range").orderBy(F.col("__t").asc_nulls_first(), "__kind", "__order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = reduce(DataFrame.unionByName, kinds).withColumn("__seen", F.last("__row", ignorenulls=True).over(line)).where("__kind = 1")
    known = F.when(reduce(Column.__and__, [c.isNotNull() for c in (F.col("__t"), *keys)]), F.col("__seen"))  # NULL keys meet nothing
    return seen.select(*[F.col(f"__own.{c}").alias(c) for c in left.columns], *[known[c].alias(c) for c in taken])

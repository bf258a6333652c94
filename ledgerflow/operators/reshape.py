"""Wide -> long, date spines, gap-filled running balances.

Balances are kept as intervals (``running_intervals``): running sums over the
sparse rows, one per entity and active day (one window, one shuffle on the
entity), each valid until the entity's next active day.  Reads clip them to
their range, take the last one, or weigh them by their days; only a mart whose
grain is the day (``densify``) writes a row per day, by a narrow ``explode``.
No dates × entities spine is built, joined or shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot_columns(df: DataFrame, ids: Sequence[str], columns: Mapping[str, str],
                    name_col: str, value_col: str) -> DataFrame:
    """Wide -> long: one output row per (input row, column); ``columns`` maps column -> label.

    One scan and one ``Expand``; a filter on the value column placed after it
    is applied per produced row.
    """
    renamed = df.select(*ids, *[F.col(c).alias(label) for c, label in columns.items()])
    return renamed.unpivot(list(ids), list(columns.values()), name_col, value_col)


def running_intervals(sparse: DataFrame, entity: Sequence[str], date_col: str, flows: Sequence[str],
                      balances: Mapping[str, Column], start: Column | None = None, end: Column | None = None) -> DataFrame:
    """Running balances as intervals: (entity, from_date, to_date, flows, balances), both dates included.

    An interval begins on an active day, carries that day's flows and the balance
    after it, and lasts until the day before the entity's next active day (the last
    one until ``end``).  An entity whose first activity lies after ``start`` has one
    more interval before it, with zeros.  So the intervals of an entity tile the
    calendar, and there are as many rows as active days plus one per entity.

    ``sparse`` has at most one row per (entity, date).  ``balances`` maps an output
    name to a per-row expression over the flows; its running sum by date is kept.
    ``start``/``end`` default to the first and last date of ``sparse``.
    """
    if start is None or end is None:
        lo, hi = sparse.agg(F.min(date_col), F.max(date_col)).first()  # one aggregate, passed as literals
        start = F.lit(lo) if start is None else start
        end = F.lit(hi) if end is None else end
    w = Window.partitionBy(*entity).orderBy(date_col)
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    staged = sparse.select(
        *entity, F.col(date_col).alias("from_date"), *flows,
        *[F.sum(expr).over(running).alias(name) for name, expr in balances.items()],
        F.lead(date_col).over(w).alias("__next"),
        F.lag(date_col).over(w).isNull().alias("__first"),
    )
    values = [*flows, *balances]
    kind = {f.name: f.dataType for f in staged.schema.fields}
    own = F.struct("from_date", F.coalesce(F.date_sub("__next", 1), end).alias("to_date"), *values)
    before = F.struct(start.alias("from_date"), F.date_sub("from_date", 1).alias("to_date"), *[F.lit(0).cast(kind[v]).alias(v) for v in values])
    both = F.when(F.col("__first") & (F.col("from_date") > start), F.array(before, own)).otherwise(F.array(own))
    return staged.select(*entity, F.inline(both))


def clip(intervals: DataFrame, flows: Sequence[str], lo: Column, hi: Column) -> DataFrame:
    """The parts of the intervals that lie in [lo, hi]; flows of days before ``lo`` become 0."""
    inside = intervals.where((F.col("from_date") <= hi) & (F.col("to_date") >= lo))
    early = F.col("from_date") < lo
    return inside.select([
        F.when(early, F.lit(0).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name in flows
        else F.greatest("from_date", lo).alias("from_date") if f.name == "from_date"
        else F.least("to_date", hi).alias("to_date") if f.name == "to_date" else F.col(f.name) for f in intervals.schema.fields])


def days_in(interval_from: str = "from_date", interval_to: str = "to_date") -> Column:
    """Days of an interval."""
    return F.datediff(interval_to, interval_from) + 1


def densify(intervals: DataFrame, entity: Sequence[str], date_col: str, flows: Sequence[str], balances: Sequence[str]) -> DataFrame:
    """One row per day of each interval; flows on its first day only.  A narrow explode; no spine is built or shuffled."""
    exploded = intervals.select("*", F.explode(F.sequence("from_date", "to_date", F.expr("interval 1 day"))).alias("__day"))
    first = F.col("__day") == F.col("from_date")
    return exploded.select(*entity, F.col("__day").alias(date_col),
                           *[F.when(first, F.col(f)).otherwise(F.lit(0).cast(intervals.schema[f].dataType)).alias(f) for f in flows], *balances)


def densify_running(sparse: DataFrame, entity: Sequence[str], date_col: str, flows: Sequence[str],
                    balances: Mapping[str, Column], start: Column | None = None,
                    end: Column | None = None) -> DataFrame:
    """Continuous daily rows per entity from ``start`` to ``end`` with zero-filled flows (``running_intervals``, day by day)."""
    return densify(running_intervals(sparse, entity, date_col, flows, balances, start, end), entity, date_col, flows, list(balances))

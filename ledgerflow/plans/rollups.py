"""Roll-up states of the metrics view: what dashboards read instead of the lines.

Every additive measure of the view is a sum over quantity, amount and allocated payment,
so a state holds those three sums per day and some of the dimensions, copies already
weighed in (no line is ever written out once per copy).  ``LEVELS`` lists the states from
small to large; a query reads the first that has all dimensions that it groups or filters
by.  Each is partitioned by month, so a date range reads its months only.

Distinct transactions are not additive over days: a key may occur on several.  The key
state counts the keys that occur on one day only, per day, and lists the others by name.
A range's count is the sum of the former plus the distinct names, which is exact.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerflow.functions.expr import month_start

TIME = ("month_start", "date")
SUMS = {"quantity_kg": DecimalType(38, 3), "transaction_amount": DecimalType(38, 2), "allocated_payment": DecimalType(38, 2)}
ALL = ("transaction_type", "vendor_name", "customer_name", "product_name", "rate_lookup_status", "payment_mode")
LEVELS: dict[str, tuple[str, ...]] = {
    "company": ("transaction_type",),
    "product": ("transaction_type", "product_name", "rate_lookup_status"),
    "counterparty": ("transaction_type", "vendor_name", "customer_name"),
    "full": ALL,
}


def state_of(allocated: DataFrame, level: str) -> DataFrame:
    """Sums per day and the dimensions of a level, weighed by copies."""
    return allocated.groupBy(*TIME, *LEVELS[level]).agg(*[F.sum(F.col(c) * F.col("copies")).cast(t).alias(c) for c, t in SUMS.items()])


def full_state(allocated: DataFrame) -> DataFrame:
    """Sums per day and all dimensions, weighed by copies."""
    return state_of(allocated, "full")


def roll_up(state: DataFrame, level: str) -> DataFrame:
    """A smaller state from a larger one."""
    return state.groupBy(*TIME, *LEVELS[level]).agg(*[F.sum(c).cast(t).alias(c) for c, t in SUMS.items()])


def key_state(allocated: DataFrame) -> DataFrame:
    """(month_start, date, single_day_keys, transaction_key): a count of keys seen on that day alone, or a key seen on several days.

    The days of a key are at most the days of the calendar.
    """
    days = allocated.groupBy("transaction_key").agg(F.collect_set("date").alias("days"))
    one = days.where(F.size("days") == 1).groupBy(F.col("days")[0].alias("date")).agg(F.count("*").alias("single_day_keys")) \
        .withColumn("transaction_key", F.lit(None).cast("string"))
    more = days.where(F.size("days") > 1).select(F.explode("days").alias("date"), F.lit(0).cast("long").alias("single_day_keys"), "transaction_key")
    return one.unionByName(more).select(month_start("date").alias("month_start"), "date", "single_day_keys", "transaction_key")


def level_for(dimensions: Iterable[str]) -> str:
    """The smallest state that has the dimensions."""
    asked = set(dimensions)
    return next(level for level, has in LEVELS.items() if asked <= set(has))


def by_month(df: DataFrame) -> DataFrame:
    """Rows of a month together before a write that is partitioned by month: AQE merges small months and splits large ones."""
    return df.hint("rebalance", "month_start")

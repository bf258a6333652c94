"""Marts: payment allocation and the daily, vendor, customer and product tables.

Payment allocation works per transaction key.  Lines and payments that
share a key (copies of a form: same second, type, counterparty and payment)
fan out in the reference grain: every line meets every payment of its key.
We never build those pairs in a join.  Payments are first collapsed to
``(key, payment_amount, payment_mode, copies)`` (partial aggregation), the
lines join that compact side, and the daily marts weight their sums by
``copies``.  Only ``mart_transactions`` - the row-level table whose grain
*is* line × payment - expands the weight again, with a narrow explode.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerflow import config
from ledgerflow.functions.expr import cond_sum, month_start, round_half_away, week_start
from ledgerflow.operators import skew
from ledgerflow.operators.asof import value_literal
from ledgerflow.operators.reshape import clip, densify, densify_running, running_intervals
from ledgerflow.plans import analytics

MONEY = DecimalType(18, 2)
QTY = DecimalType(18, 3)


def payment_variants(payments: DataFrame, by_key: bool = False) -> DataFrame:
    """Payments collapsed per (key, amount, mode) with their multiplicity.

    ``by_key`` deals them by the key alone, so that a join on the key needs no second shuffle.
    """
    rows = payments.select("transaction_key", "payment_amount", "payment_mode")
    rows = rows.repartition("transaction_key") if by_key else rows
    return rows.groupBy("transaction_key", "payment_amount", "payment_mode").agg(F.count(F.lit(1)).alias("copies"))


def numbered_variants(payments: DataFrame, by_key: bool = False) -> DataFrame:
    """Payment variants, of which one per key is its ``first``."""
    first = F.row_number().over(Window.partitionBy("transaction_key").orderBy("payment_amount", "payment_mode")) == 1
    return payment_variants(payments, by_key).withColumn("first", first)


def item_totals(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("transaction_key").agg(
        F.count(F.lit(1)).alias("item_count"),
        F.sum(F.coalesce("transaction_amount", F.lit(0))).alias("total_tx_amount"))


def allocated_lines(items: DataFrame, chosen: DataFrame, payments: DataFrame, heavy: Sequence[str] = ()) -> DataFrame:
    """Valued lines with their proportional share of the transaction's payment, weighted by ``copies``.

    Lines of ordinary keys are shuffled once, by their key: the join to the rates leaves
    them sorted by it, the totals of a key are a window over that order, and the payments
    come to the same partitions.  Lines of ``heavy`` keys (few keys, any number of lines)
    are not shuffled: rates and totals of those keys are broadcast, and their payment
    variants too once a count has shown that they are few.
    """
    lines, hot_lines = skew.split(items, "transaction_key", heavy)
    rates, hot_rates = skew.split(chosen, "transaction_key", heavy)
    pays, hot_pays = skew.split(payments, "transaction_key", heavy)
    valued = analytics.value_lines(lines, rates)
    key = Window.partitionBy("transaction_key")
    totals = valued.select("*", F.count(F.lit(1)).over(key).alias("item_count"),
                           F.sum(F.coalesce("transaction_amount", F.lit(0))).over(key).alias("total_tx_amount"))
    out = _shares(totals.join(payment_variants(pays, by_key=True), "transaction_key", "left"))
    if hot_lines is not None:
        out = out.unionByName(_shares(_hot_totals(hot_lines, hot_rates).join(skew.small(payment_variants(hot_pays)), "transaction_key", "left")))
    return out


def _hot_totals(hot_lines: DataFrame, hot_rates: DataFrame) -> DataFrame:
    """Valued lines of heavy keys with the totals of their key: fewer keys than shuffle partitions, one row of rates and one of totals each."""
    valued = analytics.value_joined(hot_lines.join(F.broadcast(analytics.key_rates(hot_rates)), "transaction_key", "left"))
    return valued.join(F.broadcast(item_totals(valued)), "transaction_key", "left")


def allocated_forms(stg: DataFrame, items: DataFrame, payments: DataFrame, rates: DataFrame, heavy: Sequence[str] = (),
                    stage: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None) -> DataFrame:
    """``allocated_lines`` from the typed log, with ``first``: TRUE once per line, whatever payments its key has.

    Forms of ordinary keys are shuffled twice, before their lines are written out: to the rates of their counterparty and
    quarter, and to their key, where rates, totals and payments meet.  Heavy keys go the way of ``allocated_lines``.
    ``stage(name, build)`` (optional) writes what lies between the shuffles, so that the files of one are gone before the next.
    """
    keep = ["transaction_timestamp", "transaction_date", "transaction_type", "vendor_name", "customer_name", "payment_rs"]
    pays, hot_pays = skew.split(payments, "transaction_key", heavy)
    plain = stg if not heavy else skew.split(analytics.with_transaction_key(stg), "transaction_key", heavy)[0]
    last_day = value_literal(items.agg(F.max("transaction_date")).first()[0])
    # the key is a hash of what the form carries: it is taken after the first shuffle
    dated = analytics.dated_forms(plain, rates, keep, last_day, stage)
    dated = dated if stage is None else stage("dated", lambda: dated)
    packed = lambda df: df.withColumn("transaction_key", F.unhex("transaction_key"))  # noqa: E731 - half as long in a shuffle
    met = analytics.form_lines(packed(analytics.with_transaction_key(dated))).join(numbered_variants(packed(pays), by_key=True), "transaction_key", "left")
    lines = met.select(F.lower(F.hex("transaction_key")).alias("transaction_key"), *[c for c in met.columns if c not in ("lines", "transaction_key")], F.inline("lines")).where("quantity_kg IS NOT NULL").withColumn("rate_lookup_status", analytics.line_status())
    first = F.coalesce("first", F.lit(True)).alias("first")
    out = _shares(lines, first)
    if heavy:
        hot_lines = skew.split(items, "transaction_key", heavy)[1]
        totals = _hot_totals(hot_lines, analytics.choose_rates(hot_lines, rates))
        out = out.unionByName(_shares(totals.join(skew.small(numbered_variants(hot_pays)), "transaction_key", "left"), first))
    return out


def enriched_lines(allocated: DataFrame) -> DataFrame:
    """The valued lines in ``allocated_forms``, without their payments."""
    return allocated.where("first").select(
        "transaction_key", F.col("date").alias("transaction_date"), "transaction_type", "vendor_name", "customer_name", "product_name",
        "quantity_kg", "applicable_rate", F.when(F.col("applicable_rate").isNotNull(), F.col("transaction_amount")).alias("transaction_amount"), "rate_lookup_status")


def _shares(j: DataFrame, *more: Column) -> DataFrame:
    """share = round(payment × amount / total, 2) when the key's total amount is
    positive, else round(payment / line_count, 2) (equal split).  The
    arithmetic is DOUBLE with half-away-from-zero rounding, as in the source
    engine; the rounded share is then held as an exact decimal(18,2).
    """
    pay = F.coalesce(F.col("payment_amount"), F.lit(0).cast(DecimalType(12, 2)))
    amount = F.coalesce(F.col("transaction_amount"), F.lit(0).cast(MONEY))
    share = F.when(
        F.col("total_tx_amount") > 0,
        round_half_away((pay * amount).cast("double") / F.col("total_tx_amount").cast("double")),
    ).otherwise(round_half_away(pay.cast("double") / F.col("item_count").cast("double")))
    return j.select(
        F.col("transaction_date").alias("date"),
        week_start("transaction_date").alias("week_start"),
        month_start("transaction_date").alias("month_start"),
        "transaction_key", "transaction_type", "vendor_name", "customer_name", "product_name",
        "quantity_kg", "applicable_rate",
        amount.alias("transaction_amount"),
        "rate_lookup_status", "payment_mode",
        share.cast(MONEY).alias("allocated_payment"),
        F.coalesce(F.col("copies"), F.lit(1)).alias("copies"),
        *more,
    )


MART_TRANSACTIONS_COLUMNS = [
    "date", "week_start", "month_start", "transaction_key", "transaction_type", "vendor_name",
    "customer_name", "product_name", "quantity_kg", "applicable_rate", "transaction_amount",
    "rate_lookup_status", "payment_mode", "allocated_payment",
]


#: Copies written out by one array; more of them are written in several.
COPIES_AT_A_TIME = 4096


def mart_transactions(allocated: DataFrame) -> DataFrame:
    """Row grain of the reference: one row per line × matching payment row.

    Copies are written out in two narrow steps, so that no array grows with them.
    """
    step = F.lit(COPIES_AT_A_TIME)
    blocks = allocated.select(*MART_TRANSACTIONS_COLUMNS, "copies", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / step))).alias("_block"))
    left = F.least(step, F.col("copies") - F.col("_block") * step).cast("int")
    return blocks.select(*MART_TRANSACTIONS_COLUMNS, F.explode(F.array_repeat(F.lit(0), left)).alias("_n")).drop("_n")


def _w(c: str) -> Column:
    """Value weighted by its multiplicity."""
    return F.col(c) * F.col("copies")


def daily_flows(allocated: DataFrame) -> DataFrame:
    """Six conditional sums per date (sparse: active days only)."""
    p = F.col("transaction_type") == config.PURCHASE
    s = F.col("transaction_type") == config.SALE
    return allocated.groupBy("date").agg(
        cond_sum(p, _w("quantity_kg")).cast(QTY).alias("purchase_qty"),
        cond_sum(p, _w("transaction_amount")).cast(MONEY).alias("purchase_amount"),
        cond_sum(s, _w("quantity_kg")).cast(QTY).alias("sales_qty"),
        cond_sum(s, _w("transaction_amount")).cast(MONEY).alias("sales_amount"),
        cond_sum(p, _w("allocated_payment")).cast(MONEY).alias("payments_paid"),
        cond_sum(s, _w("allocated_payment")).cast(MONEY).alias("payments_received"),
    )


DAILY_FLOWS = ["purchase_qty", "purchase_amount", "sales_qty", "sales_amount", "payments_paid", "payments_received"]


def _calendar(days: DataFrame) -> tuple[Column, Column]:
    """First and last date as literals: a scan of the date column, so no aggregate runs twice for it."""
    lo, hi = days.agg(F.min("date"), F.max("date")).first()
    return F.lit(lo).cast("date"), F.lit(hi).cast("date")


def daily_metrics(allocated: DataFrame) -> DataFrame:
    """Continuous company calendar with running payable and receivable balances.

    The running window has no partition key, but its input is one row per
    active day (bounded by the calendar, not by the data volume).
    """
    flows = daily_flows(allocated)
    return densify_running(flows, [], "date", DAILY_FLOWS, {
        "outstanding_payable": F.col("purchase_amount") - F.col("payments_paid"),
        "outstanding_receivable": F.col("sales_amount") - F.col("payments_received"),
    }, *_calendar(allocated)).select("date", *DAILY_FLOWS, "outstanding_payable", "outstanding_receivable")


VENDOR_FLOWS = ("purchase_qty", "purchase_amount", "payments_paid")
CUSTOMER_FLOWS = ("sales_qty", "sales_amount", "payments_received")


def _entity_lines(allocated: DataFrame, ttype: str, entity: str) -> DataFrame:
    return allocated.where((F.col("transaction_type") == ttype) & F.col(entity).isNotNull())


def _entity_daily(allocated: DataFrame, ttype: str, entity: str, names: tuple[str, str, str]) -> DataFrame:
    qty, amt, paid = names
    return _entity_lines(allocated, ttype, entity).groupBy("date", entity).agg(
        F.sum(_w("quantity_kg")).cast(QTY).alias(qty),
        F.sum(_w("transaction_amount")).cast(MONEY).alias(amt),
        F.sum(_w("allocated_payment")).cast(MONEY).alias(paid))


def vendor_daily(allocated: DataFrame) -> DataFrame:
    return _entity_daily(allocated, config.PURCHASE, "vendor_name", VENDOR_FLOWS)


def customer_daily(allocated: DataFrame) -> DataFrame:
    return _entity_daily(allocated, config.SALE, "customer_name", CUSTOMER_FLOWS)


def vendor_intervals(allocated: DataFrame) -> DataFrame:
    """(vendor, from_date, to_date, flows, ``outstanding_payable``) on the vendors' shared calendar."""
    return running_intervals(vendor_daily(allocated), ["vendor_name"], "date", VENDOR_FLOWS,
                             {"outstanding_payable": F.col("purchase_amount") - F.col("payments_paid")},
                             *_calendar(_entity_lines(allocated, config.PURCHASE, "vendor_name")))


def customer_intervals(allocated: DataFrame) -> DataFrame:
    """(customer, from_date, to_date, flows, ``outstanding_receivable``) on the customers' shared calendar."""
    return running_intervals(customer_daily(allocated), ["customer_name"], "date", CUSTOMER_FLOWS,
                             {"outstanding_receivable": F.col("sales_amount") - F.col("payments_received")},
                             *_calendar(_entity_lines(allocated, config.SALE, "customer_name")))


def vendor_summary(intervals: DataFrame) -> DataFrame:
    """(date, vendor): every vendor on every day of the shared calendar with the running ``outstanding_payable``."""
    return densify(intervals, ["vendor_name"], "date", VENDOR_FLOWS, ["outstanding_payable"]) \
        .select("date", "vendor_name", *VENDOR_FLOWS, "outstanding_payable")


def customer_summary(intervals: DataFrame) -> DataFrame:
    """(date, customer): every customer on every day of the shared calendar with the running ``outstanding_receivable``."""
    return densify(intervals, ["customer_name"], "date", CUSTOMER_FLOWS, ["outstanding_receivable"]) \
        .select("date", "customer_name", *CUSTOMER_FLOWS, "outstanding_receivable")


def balances_in(intervals: DataFrame, entity: str, flows: Sequence[str], balance: str, lo: Column, hi: Column) -> DataFrame:
    """Per entity: flows summed over [lo, hi] and the balance of the last day in it; read off the intervals, no day rows."""
    part = clip(intervals, flows, lo, hi)
    return part.groupBy(entity).agg(*[F.sum(f).alias(f) for f in flows], F.max_by(balance, "from_date").alias(balance))


def product_summary(allocated: DataFrame) -> DataFrame:
    """(date, product) conditional sums; sparse, no calendar."""
    p = F.col("transaction_type") == config.PURCHASE
    s = F.col("transaction_type") == config.SALE
    return allocated.groupBy("date", "product_name").agg(
        cond_sum(p, _w("quantity_kg")).cast(QTY).alias("purchase_qty"),
        cond_sum(s, _w("quantity_kg")).cast(QTY).alias("sales_qty"),
        cond_sum(p, _w("transaction_amount")).cast(MONEY).alias("purchase_amount"),
        cond_sum(s, _w("transaction_amount")).cast(MONEY).alias("sales_amount"),
    )

"""Analytics layer: product lines, payment events, rate history, valued lines.

Shuffle budget of ``transaction_items_enriched`` (the only wide step here):

* lookups: ``groupBy(key, product)`` with partial aggregation - a group of
  copies of one form collapses map-side to one row per map task;
* as-of: lookups ⋈ rate intervals on (side, counterparty, month) - see
  ``operators.asof``;
* lines ⋈ the rates of their key, on the key; lines of keys that hold more than a
  partition's share of all forms stay where they were read (``operators.skew``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerflow import config
from ledgerflow.functions.expr import pick_by_name, transaction_key
from ledgerflow.operators.asof import asof_join, value_literal
from ledgerflow.operators.reshape import unpivot_columns
from ledgerflow.operators.skew import split_join

RATE_BY_PRODUCT = dict(zip(config.PRODUCT_NAMES, config.RATE_COLUMNS))


def with_transaction_key(stg: DataFrame) -> DataFrame:
    return stg.withColumn("transaction_key", transaction_key(
        "transaction_timestamp", "transaction_type", "vendor_name", "customer_name", "payment_rs"))


def transaction_items(stg: DataFrame) -> DataFrame:
    """Wide log -> one line per (form row, product) with quantity > 0."""
    keyed = with_transaction_key(stg)
    ids = ["transaction_key", "transaction_timestamp", "transaction_date", "transaction_type",
           "vendor_name", "customer_name", "remarks"]
    long = unpivot_columns(keyed, ids, dict(zip(config.QTY_COLUMNS, config.PRODUCT_NAMES)),
                           "product_name", "quantity_kg")
    return long.where(F.col("quantity_kg") > 0).select(
        "transaction_key", "transaction_timestamp", "transaction_date", "transaction_type",
        "vendor_name", "customer_name", "product_name", "quantity_kg", "remarks")


def transaction_payment(stg: DataFrame) -> DataFrame:
    """One payment event per form row with a non-zero payment (refunds kept)."""
    keyed = with_transaction_key(stg)
    ptype = (F.when(F.col("transaction_type") == config.PURCHASE, F.lit(config.VENDOR_PAYMENT))
             .when(F.col("transaction_type") == config.SALE, F.lit(config.CUSTOMER_COLLECTION)))
    return keyed.where(F.col("payment_rs") != 0).select(
        "transaction_key", "transaction_timestamp", "transaction_date",
        ptype.alias("payment_type"), "vendor_name", "customer_name",
        F.col("payment_rs").alias("payment_amount"), "payment_mode", "remarks")


def rate_history(stg_rates: DataFrame, name_col: str) -> DataFrame:
    """Wide rate rows -> (name, product, effective_from, rate, remarks); NULL rates kept."""
    long = unpivot_columns(stg_rates, [name_col, "effective_from", "remarks"],
                           dict(zip(config.RATE_COLUMNS, config.PRODUCT_NAMES)), "product_name", "rate_rs")
    return long.select(name_col, "product_name", "effective_from", "rate_rs", "remarks")


def unified_rates(stg_vendor_rates: DataFrame, stg_customer_rates: DataFrame) -> DataFrame:
    """Both rate tabs as one frame keyed (side, counterparty): side = the transaction type it prices."""
    cols = ["effective_from", *config.RATE_COLUMNS]
    v = stg_vendor_rates.select(F.lit(config.PURCHASE).alias("side"),
                                F.col("vendor_name").alias("counterparty"), *cols)
    c = stg_customer_rates.select(F.lit(config.SALE).alias("side"),
                                  F.col("customer_name").alias("counterparty"), *cols)
    return v.unionByName(c)


def counterparty_of(ttype: str = "transaction_type") -> F.Column:
    return (F.when(F.col(ttype) == config.PURCHASE, F.col("vendor_name"))
            .when(F.col(ttype) == config.SALE, F.col("customer_name")))


def rate_lookups(items: DataFrame) -> DataFrame:
    """One as-of lookup per (transaction_key, product).

    Lines that share a key (copies of a form) share the rate that is in force
    on the latest of their dates - the newest rate row over the union of
    their candidates - so the lookup date is ``max(transaction_date)``.
    """
    return (items.where(F.col("transaction_type").isin(config.PURCHASE, config.SALE))
            .groupBy("transaction_key", "product_name",
                     F.col("transaction_type").alias("side"), counterparty_of().alias("counterparty"))
            .agg(F.max("transaction_date").alias("lookup_date")))


def choose_rates(items: DataFrame, rates: DataFrame) -> DataFrame:
    """(transaction_key, product_name, applicable_rate, effective_from) for every matched lookup.

    The newest rate *row* wins, then its cell for the product is read, so a
    NULL cell on the newest row gives NULL (no fall back to older rows).
    """
    lookups = rate_lookups(items)
    # Open intervals are capped at the largest line date: a column-pruned max over the lines
    # (no shuffle), evaluated once; max(lookup_date) would need the lookups' aggregation again.
    upper = value_literal(items.agg(F.max("transaction_date")).first()[0])
    hit = asof_join(lookups, rates, ["side", "counterparty"], "lookup_date", "effective_from",
                    how="inner", tiebreak=list(config.RATE_COLUMNS), upper_bound=upper)
    return hit.select("transaction_key", "product_name",
                      pick_by_name("product_name", RATE_BY_PRODUCT).alias("applicable_rate"),
                      "effective_from")


def dated_forms(stg: DataFrame, rates: DataFrame, keep: Sequence[str], upper_bound: Column | None = None,
                stage: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None) -> DataFrame:
    """Form rows with at least one line: the columns of ``keep``, quantities, and the rate row in force on the form's date.

    A rate row prices every product, so a form asks once, whatever its lines.  A form without
    counterparty or date meets no rate row; it asks under a name of its own, so that such forms do not gather.
    """
    asks = counterparty_of().isNotNull() & F.col("transaction_date").isNotNull()
    alone = F.xxhash64(*[F.col(c) for c in (*keep, *config.QTY_COLUMNS)]).cast("string")
    forms = stg.where(F.greatest(*config.QTY_COLUMNS) > 0).select(
        *keep, *config.QTY_COLUMNS, F.when(asks, F.col("transaction_type")).otherwise(F.lit("")).alias("__side"),
        F.when(asks, counterparty_of()).otherwise(alone).alias("__counterparty"))
    priced = rates.withColumnsRenamed({"side": "__side", "counterparty": "__counterparty"})
    # the names come first: rows are sorted by a key's first bytes, which the two sides share
    hit = asof_join(forms, priced, ["__counterparty", "__side"], "transaction_date", "effective_from",
                    how="left", tiebreak=list(config.RATE_COLUMNS), upper_bound=upper_bound, stage=stage)
    return hit.drop("__side", "__counterparty")


def form_lines(forms: DataFrame) -> DataFrame:
    """Forms with the rate rows of their own dates (``dated_forms``, with ``transaction_key``) -> form rows with
    ``lines`` (a valued line or NULL per product), and the number and the amount of all lines of their key.

    Lines that share a key share the rate of the latest of their dates.  Later dates never have older rate rows, so
    that is the newest row that any of them met; of two parties in one key the newer row counts, on equal dates the larger rate.
    """
    key = Window.partitionBy("transaction_key")
    slots = list(zip(config.QTY_COLUMNS, config.PRODUCT_NAMES, config.RATE_COLUMNS))
    newest = forms.select("*", *[
        F.max(F.when((F.col(q) > 0) & F.col("effective_from").isNotNull(), F.struct("effective_from", F.col(r).alias("rate")))).over(key)["rate"].alias(f"__{r}")
        for q, _, r in slots])
    amount = {q: F.round(F.col(q) * F.col(f"__{r}"), 2).cast(DecimalType(18, 2)) for q, _, r in slots}
    lines = F.array(*[
        F.when(F.col(q) > 0, F.struct(F.lit(name).alias("product_name"), F.col(q).alias("quantity_kg"), F.col(f"__{r}").alias("applicable_rate"), amount[q].alias("transaction_amount")))
        for q, name, r in slots])
    count = reduce(Column.__add__, [F.when(F.col(q) > 0, F.lit(1)).otherwise(F.lit(0)) for q, _, _ in slots])
    zero = F.lit(0).cast(DecimalType(18, 2))
    total = reduce(Column.__add__, [F.when(F.col(q) > 0, F.coalesce(amount[q], zero)).otherwise(zero) for q, _, _ in slots])
    return newest.select("transaction_key", "transaction_date", "transaction_type", "vendor_name", "customer_name", lines.alias("lines"),
                         F.sum(count).over(key).alias("item_count"), F.sum(total).over(key).alias("total_tx_amount"))


def line_status() -> Column:
    return F.when(F.col("applicable_rate").isNotNull(), F.lit(config.MATCHED)).otherwise(F.lit(config.MISSING_RATE))


def key_rates(chosen: DataFrame) -> DataFrame:
    """(transaction_key, one rate per product slot) - one row per key.

    Two parties can share a key (a ``|`` in a name), so per (key, product) the
    newest rate row is taken, on equal dates the larger rate.  Keying the line
    join on ``transaction_key`` alone lets the per-key totals and the payment
    join of the allocation reuse the same hash partitioning.
    """
    newest = [F.max(F.when(F.col("product_name") == n, F.struct("effective_from", "applicable_rate"))).alias(f"__{c}")
              for n, c in zip(config.PRODUCT_NAMES, config.RATE_COLUMNS)]
    return chosen.groupBy("transaction_key").agg(*newest)


def value_lines(items: DataFrame, chosen: DataFrame, heavy: Sequence[str] = ()) -> DataFrame:
    """Attach the chosen rate to every line and value it; lines of ``heavy`` keys are not shuffled."""
    return value_joined(split_join(items, key_rates(chosen), "transaction_key", heavy))


def value_joined(joined: DataFrame) -> DataFrame:
    """Value lines that carry the rates of their key (``key_rates``)."""
    rate = pick_by_name("product_name", {n: F.col(f"__{c}.applicable_rate") for n, c in zip(config.PRODUCT_NAMES, config.RATE_COLUMNS)})
    enriched = joined.withColumn("applicable_rate", rate)
    amount = F.when(F.col("applicable_rate").isNotNull(),
                    F.round(F.col("quantity_kg") * F.col("applicable_rate"), 2).cast(DecimalType(18, 2)))
    return enriched.select(
        "transaction_key", "transaction_date", "transaction_type", "vendor_name", "customer_name",
        "product_name", "quantity_kg", "applicable_rate", amount.alias("transaction_amount"),
        line_status().alias("rate_lookup_status"))


def transaction_items_enriched(items: DataFrame, stg_vendor_rates: DataFrame,
                               stg_customer_rates: DataFrame) -> DataFrame:
    return value_lines(items, choose_rates(items, unified_rates(stg_vendor_rates, stg_customer_rates)))

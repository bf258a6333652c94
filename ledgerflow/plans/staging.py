"""Staging: tolerant typing of the three all-string tabs (narrow maps only)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow import config
from ledgerflow.functions.expr import (
    blank_to_null, canonical_type, default_payment_mode, parse_date, parse_timestamp,
    resolve_business_date, to_decimal,
)


def stg_transaction_log(raw: DataFrame, run_date: _dt.date = config.RUN_DATE, keep: list[str] | None = None) -> DataFrame:
    """Typed log: timestamp, raw and resolved business date, canonical type, money and quantities.

    ``keep`` names extra raw columns carried through unchanged (e.g. row identity).
    """
    keep = list(keep or [])
    ts = parse_timestamp("timestamp")
    date_raw = F.when(blank_to_null("transaction_date").isNull(), F.lit(None).cast("date")) \
        .otherwise(parse_date("transaction_date"))
    payment = to_decimal("payment_rs", 12, 2, default=0)
    parsed = raw.select(
        ts.alias("transaction_timestamp"),
        date_raw.alias("transaction_date_raw"),
        canonical_type("transaction_type").alias("transaction_type"),
        blank_to_null("vendor_name").alias("vendor_name"),
        blank_to_null("customer_name").alias("customer_name"),
        payment.alias("payment_rs"),
        default_payment_mode(payment, "payment_mode").alias("payment_mode"),
        *[to_decimal(c, 10, 3, default=0).alias(c) for c in config.QTY_COLUMNS],
        blank_to_null("remarks").alias("remarks"),
        *keep,
    )
    total = sum((F.col(c) for c in config.QTY_COLUMNS[1:]), F.col(config.QTY_COLUMNS[0]))
    return parsed.select(
        "transaction_timestamp", "transaction_date_raw",
        resolve_business_date("transaction_timestamp", "transaction_date_raw", run_date).alias("transaction_date"),
        "transaction_type", "vendor_name", "customer_name", "payment_rs", "payment_mode",
        *config.QTY_COLUMNS,
        total.alias("total_qty_kg"),
        "remarks",
        *keep,
    )


def rate_cells(name_col: str, name: str | None = None) -> list[Column]:
    """Typed date, name (as ``name``) and rates of a raw rate row."""
    return [parse_date("effective_from").alias("effective_from"), blank_to_null(name_col).alias(name or name_col),
            *[to_decimal(c, 10, 2).alias(c) for c in config.RATE_COLUMNS]]


def stg_rates(raw: DataFrame, name_col: str) -> DataFrame:
    """Typed rate rows; rows with a NULL effective date or name are dropped."""
    return raw.select(*rate_cells(name_col), blank_to_null("remarks").alias("remarks")).where(F.col("effective_from").isNotNull() & F.col(name_col).isNotNull())


def stg_vendor_rates(raw: DataFrame) -> DataFrame:
    return stg_rates(raw, "vendor_name")


def stg_customer_rates(raw: DataFrame) -> DataFrame:
    return stg_rates(raw, "customer_name")

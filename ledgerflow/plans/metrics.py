"""Semantic layer: metrics views compiled to one ``groupBy().agg()``.

A ``MetricsView`` is (time column, dimensions, named aggregate measures).
``query`` filters (time range + dimension chips, pushed to the scan by
Catalyst), groups by an optional time grain and any dimensions, and
evaluates the requested measures in one aggregation with partial
(map-side) combine.  Nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow import config
from ledgerflow.functions.expr import cond_sum

Measure = Callable[[], Column]


@dataclass
class MetricsView:
    name: str
    time_col: str
    dimensions: Sequence[str]
    measures: Mapping[str, Measure]
    semi_additive: Mapping[str, str] = field(default_factory=dict)  # measure -> entity dimension

    def measure(self, name: str) -> Column:
        return self.measures[name]().alias(name)

    def filtered(self, df: DataFrame, time_range: tuple[_dt.date, _dt.date] | None = None,
                 where: Mapping[str, Sequence] | None = None) -> DataFrame:
        if time_range is not None:
            df = self.within(df, time_range)
        for dim, values in (where or {}).items():
            if dim not in self.dimensions and dim != self.time_col:
                raise KeyError(f"{dim} is not a dimension of {self.name}")
            df = df.where(F.col(dim).isin(list(values)))
        return df

    def within(self, df: DataFrame, *ranges: tuple[_dt.date, _dt.date]) -> DataFrame:
        """Rows in any of the date ranges; a table with a ``month_start`` partition column is read by months."""
        t = F.col(self.time_col)
        keep = reduce(Column.__or__, [t.between(F.lit(lo), F.lit(hi)) for lo, hi in ranges])
        if "month_start" in df.columns:
            months = reduce(Column.__or__, [F.col("month_start").between(F.lit(lo.replace(day=1)), F.lit(hi)) for lo, hi in ranges])
            df = df.where(months)
        return df.where(keep)

    def query(self, df: DataFrame, measures: Sequence[str] | None = None, dims: Sequence[str] = (),
              grain: str | None = None, time_range: tuple[_dt.date, _dt.date] | None = None,
              where: Mapping[str, Sequence] | None = None, order_by: Sequence[Column] | None = None,
              limit: int | None = None) -> DataFrame:
        """``SELECT [trunc(time)], dims, measures FROM view WHERE range AND chips GROUP BY ...``."""
        measures = list(measures or self.measures)
        for d in dims:
            if d not in self.dimensions:
                raise KeyError(f"{d} is not a dimension of {self.name}")
        keys: list[Column] = []
        if grain is not None:
            keys.append(F.date_trunc(grain, F.col(self.time_col)).cast("date").alias(self.time_col))
        keys += [F.col(d) for d in dims]
        data = self.filtered(df, time_range, where)
        aggs = [self.measure(m) for m in measures]
        out = data.groupBy(*keys).agg(*aggs) if keys else data.agg(*aggs)
        if order_by is not None:
            out = out.orderBy(*order_by)
        if limit is not None:
            out = out.limit(limit)
        return out

    def compare(self, df: DataFrame, measures: Sequence[str], current: tuple[_dt.date, _dt.date],
                previous: tuple[_dt.date, _dt.date], where: Mapping[str, Sequence] | None = None) -> DataFrame:
        """KPI comparison: (measure, current_value, previous_value, delta, percent_change).

        One scan: rows of both ranges are labelled with their period and
        aggregated by label (two rows), then folded to one row per measure.
        """
        t = F.col(self.time_col)
        period = (F.when(t.between(F.lit(current[0]), F.lit(current[1])), F.lit("current"))
                  .when(t.between(F.lit(previous[0]), F.lit(previous[1])), F.lit("previous")))
        data = self.filtered(self.within(df, current, previous), None, where).withColumn("__period", period).where(F.col("__period").isNotNull())
        per = data.groupBy("__period").agg(*[self.measure(m).cast("double") for m in measures])
        folded = per.agg(*[
            c for m in measures for c in (
                F.max(F.when(F.col("__period") == "current", F.col(m))).alias(f"{m}__cur"),
                F.max(F.when(F.col("__period") == "previous", F.col(m))).alias(f"{m}__prev"))
        ])
        rows = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"{m}__cur").alias("current_value"),
                                  F.col(f"{m}__prev").alias("previous_value")) for m in measures])
        long = folded.select(F.inline(rows))
        return long.select(
            "measure",
            F.coalesce("current_value", F.lit(0.0)).alias("current_value"),
            F.coalesce("previous_value", F.lit(0.0)).alias("previous_value"),
        ).select(
            "*",
            (F.col("current_value") - F.col("previous_value")).alias("delta"),
            F.when(F.col("previous_value") != 0,
                   (F.col("current_value") - F.col("previous_value")) / F.col("previous_value"))
            .alias("percent_change"),
        )


def last_non_null(value: str, order: str) -> Column:
    """``arg_max(value, order)`` skipping NULL values (Spark's ``max_by`` would keep them)."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))


def semi_additive_total(df: DataFrame, entity: str, time_col: str, value: str,
                        group: Sequence[str] = ()) -> DataFrame:
    """Balance 'as of period end' summed over entities: last value per entity, then sum.

    Two partial aggregations; a hot entity collapses map-side.
    """
    last = df.groupBy(*group, entity).agg(last_non_null(value, time_col).alias(value))
    return last.groupBy(*group).agg(F.sum(value).alias(value)) if group else last.agg(F.sum(value).alias(value))


# --- the five views -----------------------------------------------------------------

def _t(kind: str) -> Column:
    return F.col("transaction_type") == kind


def _sales() -> Column:
    return cond_sum(_t(config.SALE), F.col("transaction_amount"))


def _purchases() -> Column:
    return cond_sum(_t(config.PURCHASE), F.col("transaction_amount"))


TRANSACTIONS = MetricsView(
    name="transactions",
    time_col="date",
    dimensions=("transaction_type", "vendor_name", "customer_name", "product_name", "rate_lookup_status",
                "payment_mode"),
    measures={
        "purchase_qty": lambda: cond_sum(_t(config.PURCHASE), F.col("quantity_kg")),
        "sales_qty": lambda: cond_sum(_t(config.SALE), F.col("quantity_kg")),
        "purchase_amount": _purchases,
        "sales_amount": _sales,
        "payments_paid": lambda: cond_sum(_t(config.PURCHASE), F.col("allocated_payment")),
        "payments_received": lambda: cond_sum(_t(config.SALE), F.col("allocated_payment")),
        "outstanding_payable": lambda: cond_sum(_t(config.PURCHASE),
                                                F.col("transaction_amount") - F.col("allocated_payment")),
        "outstanding_receivable": lambda: cond_sum(_t(config.SALE),
                                                   F.col("transaction_amount") - F.col("allocated_payment")),
        "gross_margin": lambda: _sales() - _purchases(),
        "gross_margin_pct": lambda: F.when(
            _sales() > 0, (_sales() - _purchases()).cast("double") / _sales().cast("double")),
        "transaction_count": lambda: F.count_distinct(F.col("transaction_key")),
    },
)

DAILY_METRICS = MetricsView(
    name="daily_metrics",
    time_col="date",
    dimensions=(),
    measures={
        **{m: (lambda m=m: F.sum(m)) for m in ("purchase_qty", "purchase_amount", "sales_qty", "sales_amount",
                                                 "payments_paid", "payments_received")},
        "outstanding_payable": lambda: last_non_null("outstanding_payable", "date"),
        "outstanding_receivable": lambda: last_non_null("outstanding_receivable", "date"),
    },
)

VENDOR_SUMMARY = MetricsView(
    name="vendor_summary", time_col="date", dimensions=("vendor_name",),
    measures={
        **{m: (lambda m=m: F.sum(m)) for m in ("purchase_qty", "purchase_amount", "payments_paid")},
        "outstanding_payable": lambda: last_non_null("outstanding_payable", "date"),
    },
    semi_additive={"outstanding_payable": "vendor_name"},
)

CUSTOMER_SUMMARY = MetricsView(
    name="customer_summary", time_col="date", dimensions=("customer_name",),
    measures={
        **{m: (lambda m=m: F.sum(m)) for m in ("sales_qty", "sales_amount", "payments_received")},
        "outstanding_receivable": lambda: last_non_null("outstanding_receivable", "date"),
    },
    semi_additive={"outstanding_receivable": "customer_name"},
)

#: Distinct transactions from the key state (``plans.rollups``).
TRANSACTION_KEYS = MetricsView(
    name="transaction_keys", time_col="date", dimensions=(),
    measures={"transaction_count": lambda: (F.coalesce(F.sum("single_day_keys"), F.lit(0)) + F.count_distinct("transaction_key"))},
)

PRODUCT_SUMMARY = MetricsView(
    name="product_summary", time_col="date", dimensions=("product_name",),
    measures={m: (lambda m=m: F.sum(m)) for m in ("purchase_qty", "sales_qty", "purchase_amount", "sales_amount")},
)

KPI_MEASURES = ("purchase_qty", "purchase_amount", "sales_qty", "sales_amount", "payments_paid",
                "payments_received", "outstanding_payable", "outstanding_receivable")

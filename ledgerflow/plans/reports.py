"""Consumers of the marts: daily KPI digest, KPI reconciliation, dashboard queries.

The digest's five statements become one conditional aggregation over the
daily mart plus one scalar subquery for the distinct transaction count; the
reconciliation's eight-way ``UNION ALL`` becomes one aggregation unpivoted
into rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.expr import fiscal_year_start, month_start
from ledgerflow.operators.reshape import days_in
from ledgerflow.plans.metrics import KPI_MEASURES, TRANSACTION_KEYS, TRANSACTIONS, last_non_null

DIGEST_DAY_COLUMNS = ("sales_amount", "sales_qty", "purchase_amount", "purchase_qty",
                      "payments_received", "payments_paid")


def daily_digest(daily: DataFrame, lines: DataFrame, report_date: _dt.date) -> DataFrame:
    """One row of KPIs for ``report_date``; no row when the date is outside the calendar.

    ``lines``: the key state of the roll-ups, or lines with their ``transaction_key``.
    Balances are those of the latest mart day (as the digest reports them).
    """
    d = F.lit(report_date)
    is_day = F.col("date") == d
    mtd = F.col("date").between(month_start(d), d)
    fytd = F.col("date").between(fiscal_year_start(d), d)
    view = TRANSACTION_KEYS if "single_day_keys" in lines.columns else TRANSACTIONS
    txn = view.query(lines, ["transaction_count"], time_range=(report_date, report_date)).scalar()
    agg = daily.agg(
        F.sum(is_day.cast("int")).alias("__hit"),
        *[F.max(F.when(is_day, F.col(c))).alias(c) for c in DIGEST_DAY_COLUMNS],
        F.max_by("outstanding_receivable", "date").alias("outstanding_receivable"),
        F.max_by("outstanding_payable", "date").alias("outstanding_payable"),
        F.coalesce(F.sum(F.when(mtd, F.col("sales_amount"))), F.lit(0)).alias("mtd_sales_amount"),
        F.coalesce(F.sum(F.when(mtd, F.col("purchase_amount"))), F.lit(0)).alias("mtd_purchase_amount"),
        F.coalesce(F.sum(F.when(fytd, F.col("sales_amount"))), F.lit(0)).alias("fytd_sales_amount"),
        F.coalesce(F.sum(F.when(fytd, F.col("purchase_amount"))), F.lit(0)).alias("fytd_purchase_amount"),
    )
    return agg.where(F.col("__hit") > 0).select(
        d.alias("report_date"), *DIGEST_DAY_COLUMNS, txn.alias("transaction_count"),
        "outstanding_receivable", "outstanding_payable",
        "mtd_sales_amount", "mtd_purchase_amount", "fytd_sales_amount", "fytd_purchase_amount")


def kpi_daily_row(daily: DataFrame, report_date: _dt.date) -> DataFrame:
    return daily.where(F.col("date") == F.lit(report_date))


def latest_balance(daily: DataFrame) -> DataFrame:
    """Balances of the newest day (top-1 by date)."""
    return daily.orderBy(F.col("date").desc()).limit(1).select("date", "outstanding_receivable", "outstanding_payable")


def kpi_mtd_fytd(daily: DataFrame, report_date: _dt.date) -> DataFrame:
    d = F.lit(report_date)
    mtd = F.col("date").between(month_start(d), d)
    fytd = F.col("date").between(fiscal_year_start(d), d)
    return daily.agg(
        F.coalesce(F.sum(F.when(mtd, F.col("sales_amount"))), F.lit(0)).alias("mtd_sales_amount"),
        F.coalesce(F.sum(F.when(mtd, F.col("purchase_amount"))), F.lit(0)).alias("mtd_purchase_amount"),
        F.coalesce(F.sum(F.when(fytd, F.col("sales_amount"))), F.lit(0)).alias("fytd_sales_amount"),
        F.coalesce(F.sum(F.when(fytd, F.col("purchase_amount"))), F.lit(0)).alias("fytd_purchase_amount"),
    )


RECONCILE_DIGITS = {"purchase_qty": 3, "sales_qty": 3}


def reconcile_kpis(daily: DataFrame, lo: _dt.date, hi: _dt.date) -> DataFrame:
    """(metric, value) for the eight dashboard KPIs over [lo, hi], ordered by metric."""
    f = daily.where(F.col("date").between(F.lit(lo), F.lit(hi)))
    flows = [m for m in KPI_MEASURES if not m.startswith("outstanding")]
    agg = f.agg(
        *[F.round(F.sum(m), RECONCILE_DIGITS.get(m, 2)).cast("double").alias(m) for m in flows],
        *[F.round(last_non_null(m, "date"), 2).cast("double").alias(m)
          for m in ("outstanding_payable", "outstanding_receivable")],
    )
    long = agg.unpivot([], list(KPI_MEASURES), "metric", "value")
    return long.orderBy("metric")


def reconcile_totals(vendor_intervals: DataFrame, customer_intervals: DataFrame) -> DataFrame:
    """Lifetime totals: the raw sum of running balances over all days (what the
    reconciliation script prints) and the period-end total (last balance per entity, summed).

    Both come from the intervals: a balance counts once per day that it lasts, and
    an entity's last interval is the one that ends the calendar.
    """
    out = []
    for side, intervals in (("payable", vendor_intervals), ("receivable", customer_intervals)):
        balance = f"outstanding_{side}"
        end = intervals.agg(F.max("to_date")).scalar()
        both = intervals.agg(F.sum(F.col(balance) * days_in()).alias("raw"), F.sum(F.when(F.col("to_date") == end, F.col(balance))).alias("end"))
        rows = F.array(*[F.struct(F.lit(f"{name}_{balance}").alias("metric"), F.round(c, 2).cast("double").alias("value"))
                         for name, c in (("raw_sum", "raw"), ("period_end", "end"))])
        out.append(both.select(F.inline(rows)))
    return out[0].unionByName(out[1])


def kpi_grid(mart: DataFrame, time_range) -> DataFrame:
    """Dashboard row 1: the eight KPI measures, no dimensions."""
    return TRANSACTIONS.query(mart, list(KPI_MEASURES), time_range=time_range)


def sparkline(mart: DataFrame, time_range) -> DataFrame:
    return TRANSACTIONS.query(mart, list(KPI_MEASURES), grain="day", time_range=time_range,
                              order_by=[F.col("date")])


# dashboard charts: (title, view measure, group-by) - fixed values of the dashboard layout
TIME_CHARTS = ("purchase_amount", "sales_amount", "payments_paid", "payments_received", "gross_margin")
RANK_CHARTS = (("product_name", "purchase_amount"), ("product_name", "sales_amount"), ("product_name", "purchase_qty"),
               ("vendor_name", "purchase_amount"), ("vendor_name", "outstanding_payable"),
               ("customer_name", "sales_amount"), ("customer_name", "outstanding_receivable"))


def rank_chart(mart: DataFrame, dim: str, measure: str, time_range, k: int | None = None, where=None) -> DataFrame:
    """Bar chart: measure by dimension, largest first (name breaks ties)."""
    return TRANSACTIONS.query(mart, [measure], dims=[dim], time_range=time_range, where=where,
                              order_by=[F.col(measure).desc(), F.col(dim).asc_nulls_first()], limit=k)

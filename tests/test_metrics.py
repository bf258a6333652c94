import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerflow.plans import reports
from ledgerflow.plans.metrics import TRANSACTIONS, semi_additive_total

D = dt.date


def _mart(spark):
    rows = [(D(2026, 1, 5), "k1", "Purchase", "V1", None, "Lahsun", Decimal("2.000"), Decimal("100.00"), Decimal("40.00")),
            (D(2026, 1, 6), "k2", "Sale", None, "C1", "Lahsun", Decimal("1.000"), Decimal("150.00"), Decimal("150.00")),
            (D(2026, 2, 3), "k3", "Sale", None, "C1", "Baby Corn", Decimal("1.000"), Decimal("90.00"), Decimal("0.00")),
            (D(2026, 2, 4), "k4", "Purchase", "V1", None, "Baby Corn", Decimal("3.000"), Decimal("60.00"), Decimal("60.00"))]
    return spark.createDataFrame(rows, "date date, transaction_key string, transaction_type string, vendor_name string, "
                                       "customer_name string, product_name string, quantity_kg decimal(10,3), "
                                       "transaction_amount decimal(18,2), allocated_payment decimal(18,2)")


def test_query_grain_and_ratio(spark):
    out = {r.date: r for r in TRANSACTIONS.query(_mart(spark), ["sales_amount", "gross_margin", "gross_margin_pct",
                                                               "transaction_count"], grain="month").collect()}
    jan = out[D(2026, 1, 1)]
    assert jan.sales_amount == Decimal("150.00") and jan.gross_margin == Decimal("50.00")
    assert abs(jan.gross_margin_pct - 1 / 3) < 1e-12 and jan.transaction_count == 2


def test_compare_periods(spark):
    rows = {r.measure: r for r in TRANSACTIONS.compare(
        _mart(spark), ["sales_amount", "purchase_amount"], (D(2026, 2, 1), D(2026, 2, 28)),
        (D(2026, 1, 1), D(2026, 1, 31))).collect()}
    assert rows["sales_amount"].current_value == 90.0 and rows["sales_amount"].previous_value == 150.0
    assert abs(rows["sales_amount"].percent_change - (-0.4)) < 1e-12
    assert rows["purchase_amount"].delta == -40.0


def test_semi_additive_last_per_entity(spark):
    bal = spark.createDataFrame([("a", D(2026, 1, 1), 5.0), ("a", D(2026, 1, 2), 7.0), ("b", D(2026, 1, 1), 3.0),
                                 ("b", D(2026, 1, 2), None)], "e string, date date, v double")
    assert semi_additive_total(bal, "e", "date", "v").first().v == 10.0


def test_digest_outside_calendar_is_empty(spark):
    daily = spark.createDataFrame([(D(2026, 1, 1), *[Decimal("1.00")] * 8)],
                                  "date date, purchase_qty decimal(18,3), purchase_amount decimal(18,2), "
                                  "sales_qty decimal(18,3), sales_amount decimal(18,2), payments_paid decimal(18,2), "
                                  "payments_received decimal(18,2), outstanding_payable decimal(18,2), "
                                  "outstanding_receivable decimal(18,2)")
    assert reports.daily_digest(daily, _mart(spark), D(2026, 3, 1)).count() == 0
    (r,) = reports.daily_digest(daily, _mart(spark), D(2026, 1, 1)).collect()
    assert r.mtd_sales_amount == Decimal("1.00") and r.transaction_count == 0

"""Acceptance scenarios T1-T14 and the semantics notes G1-G14, as micro-fixtures."""
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import log_row, tabs_from
from ledgerflow.plans.pipeline import TradingModel

RUN = dt.date(2026, 6, 30)
Q = lambda *v: tuple(v) + ("",) * (5 - len(v))

VR = [("2026-06-01", "Ravi", "100", "150", "80", "40", "60", ""),
      ("2026-06-15", "Ravi", "110", "", "0", "45", "65", "")]
CR = [("2026-06-01", "Hotel A", "200", "250", "120", "90", "100", ""),
      ("2026-06-20", "Hotel A", "210", "260", "0", "95", "", "")]


@pytest.fixture(scope="module")
def model(spark):
    rows = [
        log_row("2026-06-10 09:00:00", "Purchase", vendor="Ravi", qty=Q("10")),                       # T1
        log_row("2026-06-10 09:05:00", "Purchase", vendor="Ravi", payment="500"),                     # T2, T14
        log_row("2026-06-10 09:10:00", "Purchase", vendor="Ravi", payment="300", mode="Online",
                qty=Q("5")),                                                                          # T3
        log_row("2026-06-11 10:00:00", "Sale", customer="Hotel A", qty=Q("", "2")),                   # T4
        log_row("2026-06-11 10:05:00", "Sale", customer="Hotel A", payment="400", mode="Cash"),       # T5
        log_row("2026-06-11 10:10:00", "Sale", customer="Hotel A", payment="100", qty=Q("1", "1")),   # T6, T7
        log_row("2026-06-12 11:00:00", "Purchase", vendor="Ravi"),                                    # T8
        log_row("2026-06-12 11:05:00", "Purchase", qty=Q("3")),                                       # T9
        log_row("2026-06-14 12:00:00", "Purchase", vendor="Ravi", qty=Q("", "", "", "2")),            # T10
        log_row("2026-06-15 12:00:00", "Purchase", vendor="Ravi", qty=Q("", "", "", "2")),            # T11
        log_row("2026-06-16 12:00:00", "Purchase", vendor="Unknown", qty=Q("4")),                     # T12
        log_row("2026-06-29 08:00:00", "Purchase", vendor="Ravi", qty=Q("1"), date="2026-06-02"),     # T13
        log_row("06/28/2026 08:00:00", "Sale", customer="Hotel A", qty=Q("", "", "1", "1", "1"),
                payment="100.00"),                                                                    # G5/G6/G7
        log_row("2026-06-21 08:00:00", "Sale", customer="Hotel A", qty=Q("", "", "1"), payment="30"),  # G6 zero rate
        log_row("2026-06-22 08:00:00", "Refund", customer="Hotel A", qty=Q("1"), payment="5"),        # G13
        log_row("2026-06-23 08:00:00", "Purchase", vendor="Ravi", qty=Q("-2", "1")),                  # G14
        log_row("03/04/2026 08:00:00", "Purchase", vendor="Ravi", qty=Q("1")),                        # G4
        log_row("2026-06-24 08:00:00", "Purchase", vendor="Ravi", qty=Q("7"), payment="70"),          # G2 pair
        log_row("2026-06-24 08:00:00", "Purchase", vendor="Ravi", qty=Q("3"), payment="70"),          # G2 pair
        log_row("2026-06-25 08:00:00", "Purchase", vendor="Ravi", payment="999"),                     # G1
    ]
    return TradingModel(tabs_from(spark, rows, VR, CR), RUN)


def _items(model, ts):
    return model.enriched.join(
        model.items.select("transaction_key", F.col("transaction_timestamp").cast("string").alias("ts")).distinct(),
        "transaction_key").where(F.col("ts") == ts).collect()


def test_t1_t3_purchase_lines_and_payments(model):
    assert len(_items(model, "2026-06-10 09:00:00")) == 1
    assert len(_items(model, "2026-06-10 09:05:00")) == 0
    pays = {str(r.transaction_timestamp): r for r in model.payments.collect()}
    assert pays["2026-06-10 09:05:00"].payment_mode == "Cash"                       # T14
    assert pays["2026-06-10 09:10:00"].payment_mode == "Online"
    assert len(_items(model, "2026-06-10 09:10:00")) == 1


def test_t4_t7_sales(model):
    assert len(_items(model, "2026-06-11 10:00:00")) == 1
    assert len(_items(model, "2026-06-11 10:05:00")) == 0
    assert len(_items(model, "2026-06-11 10:10:00")) == 2                         # T7 two products


def test_t8_noop_row_has_nothing(model):
    assert len(_items(model, "2026-06-12 11:00:00")) == 0
    assert "2026-06-12 11:00:00" not in {str(r.transaction_timestamp) for r in model.payments.collect()}


def test_t9_t12_missing_rate(model):
    assert [r.rate_lookup_status for r in _items(model, "2026-06-12 11:05:00")] == ["missing_rate"]
    assert [r.rate_lookup_status for r in _items(model, "2026-06-16 12:00:00")] == ["missing_rate"]


def test_t10_t11_rate_change(model):
    assert [r.applicable_rate for r in _items(model, "2026-06-14 12:00:00")] == [Decimal("40.00")]
    assert [r.applicable_rate for r in _items(model, "2026-06-15 12:00:00")] == [Decimal("45.00")]


def test_t13_backdated_date_drives_lookup(model):
    (r,) = _items(model, "2026-06-29 08:00:00")
    assert r.transaction_date == dt.date(2026, 6, 2) and r.applicable_rate == Decimal("100.00")


def test_g4_month_first(model):
    (r,) = _items(model, "2026-03-04 08:00:00")
    assert r.transaction_date == dt.date(2026, 3, 4) and r.rate_lookup_status == "missing_rate"


def test_g7_newest_row_null_cell_is_missing(model):
    rows = {r.product_name: r for r in _items(model, "2026-06-28 08:00:00")}
    assert rows["Mushroom B Grade"].applicable_rate == Decimal("0.00")             # zero rate counts as matched
    assert rows["Mushroom B Grade"].rate_lookup_status == "matched"
    assert rows["Lahsun"].rate_lookup_status == "missing_rate"                       # NULL cell on the newest row


def test_g5_g6_allocation(model):
    m = model.mart_transactions
    key = model.items.where(F.col("transaction_timestamp").cast("string") == "2026-06-28 08:00:00") \
        .select("transaction_key").first()[0]
    alloc = sorted(float(r.allocated_payment) for r in m.where(F.col("transaction_key") == key).collect())
    # amounts 0 (B grade rate 0), 95 (baby corn), 0 (lahsun missing) -> all of it on baby corn
    assert alloc == [0.0, 0.0, 100.0]
    key2 = model.items.where(F.col("transaction_timestamp").cast("string") == "2026-06-21 08:00:00") \
        .select("transaction_key").first()[0]
    (r,) = m.where(F.col("transaction_key") == key2).collect()
    assert float(r.allocated_payment) == 30.0                                         # total 0 -> equal split


def test_g5_equal_split_rounds_each_line(spark):
    rows = [log_row("2026-06-10 09:00:00", "Sale", customer="X", qty=Q("1", "1", "1"), payment="100.00")]
    m = TradingModel(tabs_from(spark, rows), RUN)
    assert sorted(float(r.allocated_payment) for r in m.mart_transactions.collect()) == [33.33, 33.33, 33.33]


def test_g13_unknown_type(model):
    (r,) = _items(model, "2026-06-22 08:00:00")
    assert r.transaction_type == "Refund" and r.rate_lookup_status == "missing_rate"
    pay = [p for p in model.payments.collect() if str(p.transaction_timestamp) == "2026-06-22 08:00:00"]
    assert pay[0].payment_type is None


def test_g14_negative_qty_dropped_but_counted(model):
    assert [r.product_name for r in _items(model, "2026-06-23 08:00:00")] == ["Mushroom Pannet"]
    (s,) = model.stg_log.where(F.col("transaction_timestamp").cast("string") == "2026-06-23 08:00:00").collect()
    assert s.total_qty_kg == Decimal("-1.000")


def test_g2_copies_fan_out(model):
    """Two forms with the same key: each line meets both payment rows, and both lines share one rate."""
    m = model.mart_transactions.where(F.col("date") == dt.date(2026, 6, 24)).collect()
    assert len(m) == 4
    assert sorted(float(r.allocated_payment) for r in m) == [21.0, 21.0, 49.0, 49.0]


def test_g1_payment_only_absent_from_marts(model):
    d = model.daily_metrics.where(F.col("date") == dt.date(2026, 6, 25)).first()
    assert d.payments_paid == 0


def test_daily_balance_equals_sum_of_flows(model):
    rows = sorted(model.daily_metrics.collect(), key=lambda r: r.date)
    bal = Decimal(0)
    for r in rows:
        bal += r.purchase_amount - r.payments_paid
        assert r.outstanding_payable == bal
    days = [r.date for r in rows]
    assert all((b - a).days == 1 for a, b in zip(days, days[1:]))

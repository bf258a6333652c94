import datetime as dt

import pytest
from conftest import LOG_COLUMNS, log_row, tabs_from

from ledgerflow.plans import kpis
from ledgerflow.plans.warehouse import Warehouse


def warehouse(spark, rows):
    tabs = tabs_from(spark, rows, [("2026-01-01", "Ravi", "100", "", "", "", "", "")], [("2026-01-01", "Hotel", "200", "", "", "", "", "")])
    log = spark.createDataFrame([(*r, 2 + i) for i, r in enumerate(rows)], ", ".join(f"{c} string" for c in LOG_COLUMNS) + ", source_row_number long")
    return Warehouse(log, tabs["vendor_rates"], tabs["customer_rates"], dt.date(2026, 12, 31))


ROWS = [
    log_row("2026-01-10 09:00:00", "Purchase", "Ravi", payment="100", mode="Cash", qty=("10", "", "", "", "")),
    log_row("2026-01-11 09:00:00", "Sale", "", "Hotel", payment="200", mode="Cash", qty=("4", "3", "", "", "")),   # pannet has no rate and was never sold at one
    log_row("2026-03-02 09:00:00", "Sale", "", "Cafe", qty=("1", "", "", "", "")),                                  # a customer without rates
    log_row("2026-03-03 09:00:00", "Sale", "", "Hotel", qty=("8", "", "", "", "")),
]


def test_metrics_of_products_and_counterparties(spark):
    got = {(str(r.month), r.dimension): r for r in kpis.metrics_by_entity(warehouse(spark, ROWS)).collect() if r.dimension != "customer" or r.unvalued_sales_kg != 0}
    bulk = [r for r in kpis.metrics_by_entity(warehouse(spark, ROWS)).where("dimension = 'product' and entity = 'mushroom_bulk'").collect()]
    by_month = {str(r.month): r for r in bulk}
    assert set(by_month) == {"2026-01-01", "2026-03-01"}
    jan, mar = by_month["2026-01-01"], by_month["2026-03-01"]
    assert (jan.gross_revenue, jan.purchase_cost, jan.product_gross_profit) == (800, 1000, -200)
    assert (jan.avg_selling_price_per_kg, jan.avg_purchase_price_per_kg) == (200.0, 100.0)
    assert (mar.sales_quantity_kg, mar.gross_revenue, mar.unvalued_sales_kg, mar.unvalued_sales_rs) == (9, 1600, 1, 200)
    vendor = got["2026-01-01", "vendor"]
    assert (vendor.purchase_cost, vendor.product_gross_profit) == (1000, None)
    pannet = [r for r in kpis.metrics_by_entity(warehouse(spark, ROWS)).where("entity = 'mushroom_pannet'").collect()]
    assert [(r.unvalued_sales_kg, r.unvalued_sales_rs) for r in pannet] == [(3, None)]


def test_every_month_and_day_is_judged(spark):
    got = {(r.period, r.entity, r.kpi): (r.value, r.status) for r in kpis.kpi_status(spark, warehouse(spark, ROWS)).collect()}
    # receivables: 800 - 200 in January, the same in February, 1600 more in March
    assert [got[f"2026-0{m}-01", None, "total_ar_outstanding_mom_pct"] for m in (1, 2, 3)] == [(None, "ok"), (0.0, "ok"), (pytest.approx(1600 / 600 * 100), "critical")]
    assert got["2026-03-01", None, "unvalued_sales_pct"] == (12.5, "critical") and got["2026-02-01", None, "unvalued_sales_pct"] == (None, "ok")
    assert got["2026-01-01", None, "gross_margin_pct"] == (-25.0, "critical") and got["2026-01-01", None, "collection_rate_pct"] == (25.0, "critical")
    assert got["2026-01-12", None, "transaction_count"] == (0.0, "critical")   # a Monday
    assert got["2026-01-17", None, "transaction_count"] == (0.0, "warning")    # a Saturday
    assert got["2026-01-10", None, "gross_revenue"] == (0.0, "warning") and got["2026-01-11", None, "gross_revenue"] == (800.0, "warning")
    assert got["all", "mushroom_bulk", "inventory_on_hand_qty_kg"] == (-3.0, "critical")
    assert got["all", None, "rate_match_rate"] == (60.0, "critical")
    assert sum(k[2] == "transaction_count" for k in got) == 53
    assert all(s == "ok" for (_, _, k), (v, s) in got.items() if v is None)


def test_an_empty_log_has_no_series(spark):
    got = kpis.kpi_status(spark, warehouse(spark, ROWS[:0] or [log_row("", "", "")])).collect()
    assert {r.kpi for r in got} <= {"rate_match_rate", "data_quality_error_rate", "data_quality_warning_rate"}


def test_bounds_that_are_reached_and_runs(spark):
    rows = [("p", None, k, v) for k, v in (("quarantine_new_errors", 1.0), ("source_rows_soft_deleted", 5.0), ("data_quality_error_rate", 10.0), ("rate_match_rate", 95.0),
                                           ("inventory_on_hand_qty_kg", 0.0), ("not a KPI", 1.0))]
    got = {r.kpi: r.status for r in kpis.judge(spark, spark.createDataFrame(rows, kpis.KPI)).collect()}
    assert got == {"quarantine_new_errors": "warning", "source_rows_soft_deleted": "critical", "data_quality_error_rate": "warning", "rate_match_rate": "ok",
                   "inventory_on_hand_qty_kg": "ok"}
    at = lambda d, m=0: dt.datetime(2026, 6, d, 6, m)
    runs = spark.createDataFrame([(at(1), at(1, 2), True), (at(2), at(2, 11), True), (at(3), at(3, 1), False), (at(4), at(4, 1), False)],
                                 "started_at timestamp_ntz, finished_at timestamp_ntz, ok boolean")
    found = {(r.kpi, r.value): r.status for r in kpis.judge(spark, kpis.per_run(runs)).collect()}
    assert found == {("pipeline_runtime_minutes", 2.0): "ok", ("pipeline_runtime_minutes", 11.0): "critical", ("pipeline_success_rate", 50.0): "warning",
                     ("pipeline_failures_in_a_row", 2.0): "critical"}


def test_details_name_the_parts_of_a_check(spark):
    from ledgerflow.plans import rules

    rows = [log_row("2026-01-10 09:00:00", "Sale", "Ravi", "Hotel", payment="-5", mode="Cheque", qty=("-1", "3", "2", "", "")),
            log_row("2026-01-11 09:00:00", "Purchase", "Ravi", qty=("1", "", "", "", ""))]
    wh = warehouse(spark, rows)
    got = sorted((r.check_id, r.sub_check) for r in rules.validation_details(wh).collect())
    assert len({r.source_row_id for r in rules.validation_details(wh).collect()}) == 1
    assert [g for g in got if g[0] == "quality_suspicious_business_event"] == [("quality_suspicious_business_event", p) for p in ("sale_with_vendor", "vendor_and_customer")]
    assert [g for g in got if g[0] == "quality_negative_quantity"] == [("quality_negative_quantity", "mushroom_bulk_qty_kg")]
    assert len([g for g in got if g[0] == "quality_missing_rate"]) == 2
    assert {g for g in got if g[1] is None} == {("quality_invalid_payment_mode", None), ("quality_negative_payment", None)}
    whole = rules.validation_overall(wh).first()
    assert (whole.active_rows, whole.row_pass_rate_pct, whole.warning_rate_pct) == (2, 50.0, 50.0)
    assert whole.quality_score == pytest.approx((4 * 100 + 5 * 50) / 9)

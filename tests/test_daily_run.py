import datetime as dt
import os
import tempfile

import pytest

from ledgerflow.plans.daily_run import daily_run, read_exports, run_kpis


def _write(d, name, header, rows):
    with open(os.path.join(d, f"{name}.csv"), "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_daily_run_guard_and_marts(spark):
    d = tempfile.mkdtemp(prefix="ledgerflow-tabs-")
    _write(d, "transaction_log", ["Timestamp", "Transaction Type", "Vendor Name", "Payment (Rs)", "Mushroom Bulk Qty (kg)"],
           [["2026-06-10 09:00:00", "Purchase", "V", "50", "2"], ["2026-06-12 09:00:00", "Purchase", "V", "", "1"]])
    _write(d, "vendor_rates", ["Effective From Date", "Vendor Name", "Mushroom Bulk Rate (Rs)"], [["2026-06-01", "V", "100"]])
    _write(d, "customer_rates", ["Effective From Date", "Customer Name"], [])
    out = tempfile.mkdtemp(prefix="ledgerflow-wh-")
    first = daily_run(spark, read_exports(spark, d), out, dt.date(2026, 6, 30))
    assert not first["skipped"] and first["row_delta"]["transaction_log"] == 2
    daily = spark.read.parquet(first["marts"]["mart_daily_metrics"])
    assert daily.count() == 3
    second = daily_run(spark, read_exports(spark, d), out, dt.date(2026, 6, 30))
    assert second["skipped"] and second["row_delta"] == {}
    with pytest.raises(KeyError):
        daily_run(spark, {"unknown": spark.range(1)}, out, dt.date(2026, 6, 30))
    found = {r.kpi: (r.value, r.status) for r in run_kpis(spark, out).where("kpi <> 'pipeline_runtime_minutes'").collect()}
    assert found == {"pipeline_success_rate": (pytest.approx(200 / 3), "warning"), "pipeline_failures_in_a_row": (1.0, "warning")}
    assert run_kpis(spark, out).where("kpi = 'pipeline_runtime_minutes' and value > 0").count() == 2

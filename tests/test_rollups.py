import contextlib
import datetime as dt
import io
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow.plans import marts, rollups
from ledgerflow.plans.metrics import KPI_MEASURES, TRANSACTION_KEYS, TRANSACTIONS

RANGES = [(dt.date(2026, 1, 10), dt.date(2026, 2, 5)), (dt.date(2026, 2, 1), dt.date(2026, 2, 28)), (dt.date(2025, 1, 1), dt.date(2025, 2, 1)), None]


@pytest.fixture(scope="module")
def allocated(spark):
    rows = []
    for i in range(400):
        day = dt.date(2026, 1, 1) + dt.timedelta(days=(i * 7) % 90)
        buy = i % 2 == 0
        rows.append((day, day - dt.timedelta(days=day.weekday()), day.replace(day=1), f"k{i % 130}" if i % 3 else f"u{i}", "Purchase" if buy else "Sale", f"V{i % 7}" if buy else None,
                     None if buy else f"C{i % 11}", ("Lahsun", "Baby Corn", "Mushroom Bulk")[i % 3], Decimal(i % 9) + Decimal("0.125"), Decimal("10.50"),
                     Decimal(i) + Decimal("0.25"), ("matched", "missing_rate")[i % 5 == 0], ("Cash", "Online", None)[i % 3], Decimal(i % 50), 1 + i % 4))
    return spark.createDataFrame(rows, """date date, week_start date, month_start date, transaction_key string, transaction_type string, vendor_name string,
        customer_name string, product_name string, quantity_kg decimal(10,3), applicable_rate decimal(10,2), transaction_amount decimal(18,2),
        rate_lookup_status string, payment_mode string, allocated_payment decimal(18,2), copies long""").repartition(3)


def rows_of(df):
    return sorted(([None if v is None else float(v) if isinstance(v, (Decimal, float)) else str(v) for v in r] for r in df.collect()), key=str)


@pytest.mark.parametrize("time_range", RANGES)
def test_states_answer_like_the_lines(allocated, time_range):
    lines, full = marts.mart_transactions(allocated), rollups.full_state(allocated)
    measures = [*KPI_MEASURES, "gross_margin", "gross_margin_pct"]
    for dims, grain, where in (((), None, None), ((), "day", None), (("product_name",), "month", None), (("vendor_name",), None, {"transaction_type": ["Purchase"]}),
                               (("customer_name", "payment_mode"), "week", {"product_name": ["Lahsun"]}), (("rate_lookup_status",), "quarter", None)):
        level = rollups.level_for({"transaction_type", *dims, *(where or {})})
        state = full if level == "full" else rollups.roll_up(full, level)
        assert state.count() <= full.count()
        assert rows_of(TRANSACTIONS.query(state, measures, dims, grain, time_range, where)) == rows_of(TRANSACTIONS.query(lines, measures, dims, grain, time_range, where))


def test_compare_from_a_state(allocated):
    full = rollups.roll_up(rollups.full_state(allocated), "company")
    args = (list(KPI_MEASURES), RANGES[1], (dt.date(2026, 1, 1), dt.date(2026, 1, 31)))
    assert rows_of(TRANSACTIONS.compare(full, *args)) == rows_of(TRANSACTIONS.compare(marts.mart_transactions(allocated), *args))


@pytest.mark.parametrize("time_range", RANGES)
@pytest.mark.parametrize("grain", [None, "day", "month"])
def test_distinct_transactions_are_exact(allocated, time_range, grain):
    state = rollups.key_state(allocated)
    assert state.where("single_day_keys > 0").count() and state.where("transaction_key is not null").count()
    got = TRANSACTION_KEYS.query(state, grain=grain, time_range=time_range)
    assert rows_of(got) == rows_of(TRANSACTIONS.query(allocated, ["transaction_count"], grain=grain, time_range=time_range))


def test_smallest_level():
    assert [rollups.level_for(d) for d in ((), ("product_name",), ("vendor_name", "transaction_type"), ("vendor_name", "product_name"), ("payment_mode",))] == [
        "company", "product", "counterparty", "full", "full"]


def test_a_range_reads_its_months_only(spark, allocated, tmp_path):
    path = str(tmp_path / "state")
    rollups.by_month(rollups.full_state(allocated)).write.partitionBy("month_start").parquet(path)
    state = spark.read.parquet(path)
    assert len({p.parent.name for p in (tmp_path / "state").rglob("*.parquet")}) == len(list((tmp_path / "state").rglob("*.parquet"))) == 3
    query = TRANSACTIONS.query(state, ["sales_amount"], time_range=RANGES[1])
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        query.explain()
    assert "PartitionFilters: [isnotnull(month_start" in out.getvalue()
    read = {f.rsplit("/", 2)[1] for f in state.where(F.col("month_start") == dt.date(2026, 2, 1)).select("_metadata.file_path").distinct().toPandas()["file_path"]}
    assert read == {"month_start=2026-02-01"}

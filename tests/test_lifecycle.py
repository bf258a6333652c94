import datetime as dt
import json
import os

import pytest
from conftest import LOG_COLUMNS, log_row, tabs_from
from pyspark.sql import functions as F

from ledgerflow.operators import buckets
from ledgerflow.plans import rules
from ledgerflow.plans.lifecycle import LOG_TAB, LoadHistory, orphan_facts, packed_id, unpacked_id
from ledgerflow.plans.warehouse import Warehouse

DAY = lambda n: dt.datetime(2026, 6, n, 6, 0)
RATES = [("2026-06-01", "Ravi", "100", "150", "80", "40", "60", "")]
CUSTOMERS = [("2026-06-01", "Hotel", "200", "250", "120", "90", "100", "")]
ROWS = [log_row(f"2026-06-{1 + i:02d} 09:00:00", *(("Purchase", "Ravi", "") if i % 2 else ("Sale", "", "Hotel")), payment=str(i * 10), qty=(str(1 + i), "", "", "", "")) for i in range(12)]
BAD = log_row("2026-06-20 09:00:00", "Purchase", "Ravi", payment="many", qty=("1", "", "", "", ""))


def extract(spark, rows, rates=RATES):
    tabs = tabs_from(spark, [r for r in rows], rates, CUSTOMERS)
    numbered = [(*r, 2 + i) for i, r in enumerate(rows)]
    log = spark.createDataFrame(numbered, ", ".join(f"{c} string" for c in LOG_COLUMNS) + ", source_row_number long")
    return log, tabs["vendor_rates"], tabs["customer_rates"]


def facts_of(h, name="fact_inventory"):
    return sorted(map(tuple, h.facts(name).select("source_row_id", "line_value_rs" if name == "fact_inventory" else "amount_rs", "is_deleted", "ingested_at").collect()))


@pytest.fixture(scope="module")
def days(spark, tmp_path_factory):
    """Four loads: a row is edited and one is bad; the rates change and rows move; everything is back as it was."""
    root = str(tmp_path_factory.mktemp("history") / "state")
    edited = [tuple("late" if c == "remarks" and i == 3 else v for c, v in zip(LOG_COLUMNS, r)) for i, r in enumerate(ROWS)]
    new_rates = [("2026-06-01", "Ravi", "101", "150", "80", "40", "60", "")]
    h, written, seen = LoadHistory(spark, root, dt.date(2026, 6, 30), 16), [], []
    for n, (rows, rates) in enumerate([([*ROWS, BAD], RATES), ([*edited, BAD], RATES), ([*ROWS[:3], *ROWS[4:]], new_rates), ([BAD, *ROWS], new_rates), ([BAD, *ROWS], new_rates)], 1):
        written.append(h.load(f"load-{n}", DAY(n + 20), *extract(spark, rows, rates)))
        seen.append((facts_of(h), facts_of(h, "fact_payment")))
    return h, written, seen, root


def test_every_table_is_written_at_first_and_nothing_when_nothing_changes(days):
    _, written, _, _ = days
    assert all(n > 0 for n in written[0].values()) and written[-1] == dict.fromkeys(written[0], 0)


def test_an_edit_touches_its_rows_only(days):
    _, written, seen, _ = days
    assert written[1]["spans"] <= 2 and written[1]["rows"] == 1 and written[1]["fact_inventory"] <= 2 and written[1]["errors"] == 0
    before, after = (set(x[0]) for x in seen[:2])
    assert len(before - after) == 1 and len(after - before) == 2  # the old row is marked, the new one added


def test_changed_rates_revalue_the_facts_of_their_counterparty(days):
    h, _, seen, _ = days
    values = {r.transaction_date.day: r.line_value_rs for r in h.facts("fact_inventory").where("NOT is_deleted AND movement_type = 'inventory_purchase'").collect()}
    assert values[2] == 202 and values[4] == 404
    assert {r.line_value_rs for r in h.facts("fact_inventory").where("is_deleted").collect()} == {404}  # the edited row, gone since, with today's rate


def test_facts_equal_a_full_rebuild(spark, days, tmp_path):
    h, _, _, _ = days
    again = LoadHistory(spark, str(tmp_path / "s"), dt.date(2026, 6, 30), 16)
    again.load("x", DAY(28), *extract(spark, [BAD, *ROWS], [("2026-06-01", "Ravi", "101", "150", "80", "40", "60", "")]))
    for name in ("fact_inventory", "fact_payment"):
        cells = [c for c in h.facts(name).columns if c != "ingested_at"]
        live = lambda x: sorted(map(str, x.facts(name).where("NOT is_deleted").select(*cells).collect()))
        assert live(h) == live(again) and live(h)


def test_quarantine_is_opened_resolved_and_reopened(days, spark):
    h, _, _, _ = days
    rows = sorted(h.quarantine().collect(), key=lambda r: r.quarantined_at)
    assert [(r.quarantined_at, r.resolved_at, r.resolution_notes) for r in rows] == [(DAY(21), DAY(23), "row left the source"), (DAY(24), None, None)]
    assert len({r.quarantine_id for r in rows}) == 2 and {r.rule_ids for r in rows} == {"stg_txn_payment_not_numeric"} and '"payment_rs":"many"' in rows[0].raw_row_json
    assert not h.facts("fact_inventory").join(h.quarantine(), "source_row_id", "left_semi").count()
    notes = h.quarantine().select("source_row_id", F.lit("typed again").alias("resolution_notes")).distinct()
    assert [r.resolution_notes for r in h.quarantine(notes).where("resolved_at IS NOT NULL").collect()] == ["typed again"]


def test_snapshots_and_staging(days):
    h, _, _, _ = days
    snap = h.snapshots().where(F.col("sheet_tab") == LOG_TAB)
    per = {r.load_id: (r.n, r.here) for r in snap.groupBy("load_id").agg(F.count("*").alias("n"), F.count_if("is_present").alias("here")).collect()}
    assert per == {"load-1": (13, 13), "load-2": (14, 13), "load-3": (14, 11), "load-4": (14, 13), "load-5": (14, 13)}
    assert snap.groupBy("load_id", "source_row_id").count().where("count > 1").count() == 0
    rates = h.snapshots().where("sheet_tab = 'Vendor Rates'").groupBy("load_id").agg(F.count("*").alias("n"), F.count_if("is_present").alias("p"))
    assert {tuple(r) for r in rates.collect()} == {("load-1", 1, 1), ("load-2", 1, 1), ("load-3", 2, 1), ("load-4", 2, 1), ("load-5", 2, 1)}
    (gone,) = h.staging().where("is_deleted").collect()
    assert (gone.remarks, gone.deleted_at, gone.deleted_by_load_id, gone.last_seen_load_id, gone.deletion_reason) == ("late", DAY(23), "load-3", "load-2", "source_removed")
    assert h.staging().where("NOT is_deleted").count() == 13


def test_state_is_opened_again(spark, days):
    h, _, _, root = days
    other = LoadHistory(spark, root, dt.date(2026, 6, 30), 16).open(h.loads)
    assert facts_of(other) == facts_of(h) and other.snapshots().count() == h.snapshots().count()


def test_orphans(spark, days):
    h, _, _, _ = days
    assert h.orphans().count() == 0
    facts = spark.createDataFrame([("a", True), ("b", False), ("c", False), ("d", True)], "source_row_id string, is_deleted boolean")
    staging = spark.createDataFrame([("a", False), ("b", True), ("c", False), ("d", True)], "source_row_id string, is_deleted boolean")
    assert sorted((r.rule_id, r.source_row_id) for r in orphan_facts(facts, staging).collect()) == [("tgt_deleted_row_in_marts", "b"), ("tgt_orphan_deleted_fact", "a")]


def test_a_write_that_fails_leaves_the_table_as_it_was(spark, tmp_path):
    table = buckets.Versioned(spark, str(tmp_path / "t"), "k string, v int", 8)
    rows = lambda v: buckets.with_bucket(spark.createDataFrame([(f"k{i}", v) for i in range(20)], "k string, v int"), ["k"], 8)
    table.write(rows(1))
    with pytest.raises(Exception):
        table.write(rows(2).withColumn("v", F.when(F.col("k") == "k7", F.raise_error(F.lit("lost"))).otherwise(F.col("v"))))
    again = buckets.Versioned(spark, str(tmp_path / "t"), "k string, v int", 8).open()
    assert {r.v for r in again.read().collect()} == {1} and again.read().count() == 20
    one = buckets.touched(spark.createDataFrame([("k3",)], "k string"), ["k"], 8)
    again.write(rows(5).where(F.col("bucket").isin(one)), one)
    assert again.read().where("v = 5").count() == rows(5).where(F.col("bucket").isin(one)).count() and again.read().count() == 20


def test_departures_count_rows_that_come_back_later(days):
    h = days[0]
    gone = {r.load_id: r["count"] for r in h.departures().where(F.col("sheet_tab") == LOG_TAB).groupBy("load_id").count().collect()}
    assert gone == {"load-2": 1, "load-3": 2}  # the edited row; its new form and the bad row, of which one returns


def test_a_load_adds_what_is_new_and_keeps_no_hashed_keys(spark, tmp_path):
    h = LoadHistory(spark, str(tmp_path / "s"), dt.date(2026, 6, 30), 4)
    h.load("a", DAY(21), *extract(spark, ROWS))
    edited = [tuple("late" if c == "remarks" and i == 3 else v for c, v in zip(LOG_COLUMNS, r)) for i, r in enumerate(ROWS)]
    h.load("b", DAY(22), *extract(spark, edited))
    for name, first in (("rows", 12), ("fact_inventory", 12), ("fact_payment", 11)):
        kept = {p.parent.name if p.parent.name.startswith("version") else p.parent.parent.name for p in (tmp_path / "s" / name / "data").rglob("*.parquet")}
        sizes = [spark.read.parquet(str(tmp_path / "s" / name / "data" / v)) for v in sorted(kept)]
        assert [d.count() for d in sizes] == [first, 1]  # the second load wrote one row, not what its bucket held
        assert not {"movement_id", "payment_id", "vendor_key", "customer_key"} & set(sizes[0].columns)
    assert {len(r.movement_id) for r in h.facts("fact_inventory").collect()} == {64} and h.facts("fact_inventory").where("is_deleted").count() == 1
    steps = h.snapshots()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in steps and "Window" not in steps


def test_the_quarantined_row_holds_the_cells_of_the_log_only(days):
    (raw,) = {r.raw_row_json for r in days[0].quarantine().collect()}
    assert not {"content_fingerprint", "source_row_id", "__h"} & set(json.loads(raw)) and set(LOG_COLUMNS) <= set(json.loads(raw))


def test_a_row_that_returns_is_active_again_at_the_rates_of_its_return(spark, tmp_path):
    h = LoadHistory(spark, str(tmp_path / "s"), dt.date(2026, 6, 30), 4)
    dear = [("2026-06-01", "Ravi", "300", "150", "80", "40", "60", "")]
    state = []
    for n, (rows, rates) in enumerate([(ROWS, RATES), ([r for i, r in enumerate(ROWS) if i != 3], dear), (ROWS, dear), ([r for i, r in enumerate(ROWS) if i != 3], RATES)], 1):
        h.load(f"l{n}", DAY(20 + n), *[x if k else x.withColumn("source_row_number", F.dayofmonth(F.to_timestamp("timestamp")).cast("long")) for k, x in enumerate(extract(spark, rows, rates))])
        state += [(r.line_value_rs, r.is_deleted, r.deleted_at, r.ingested_at) for r in h.facts("fact_inventory").where("quantity_kg = 4").collect()]
    assert state == [(400, False, None, DAY(21)), (1200, True, DAY(22), DAY(21)), (1200, False, None, DAY(21)), (400, True, DAY(24), DAY(21))]
    assert [r.n for r in h.departures().groupBy("sheet_tab").agg(F.count("*").alias("n")).where("sheet_tab = 'Transaction Log'").collect()] == [2]


def test_a_load_writes_spans_once_and_leaves_nothing_behind_for_itself(days):
    h, _, _, root = days
    left = {p.split("-")[0] for p in os.listdir(f"{root}/stages")}
    assert left <= {"rates"} and len(os.listdir(f"{root}/stages")) == 1
    assert h.tables["spans"].newest().count() == len(ROWS) + 2 + len(RATES) * 2 + len(CUSTOMERS)
    assert "content_fingerprint" not in h.tables["rows"].read().columns and h.staging().where("source_row_id NOT LIKE concat('%:', substring(content_fingerprint, 1, 16), '%')").count() == 0


def test_ids_of_any_form_are_packed_and_read_back(spark):
    ids = ["sheet:T:00ff00ff00ff00ff", "sheet:T:00ff00ff00ff00ff:row12", "sheet:T:00FF00ff00ff00ff", "sheet:U:00ff00ff00ff00ff", "sheet:T:00ff", "x", None]
    df = spark.createDataFrame([(i, "T") for i in ids], "source_row_id string, sheet_tab string")
    packed = df.select("*", *packed_id())
    assert [r.i for r in packed.select(unpacked_id().alias("i")).collect()] == ids
    assert [len(r.h) for r in packed.collect()] == [8, 8, 0, 0, 0, 0, 0] and packed.select("h", "k").distinct().count() == len(ids)


def test_rows_are_judged_and_typed_in_one_pass(spark):
    log, vendor, customer = extract(spark, [*ROWS, BAD, log_row("2026-06-21 09:00:00", "Gift", remarks='say "no"\\')])
    wh = Warehouse(log, vendor, customer, dt.date(2026, 6, 30))
    found, cells = rules.judged(wh), [c for c in wh.typed.columns if c != "source_row_number"]
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(found.where("rule_ids IS NOT NULL").select("source_row_id", "rule_ids", "raw_json")) == rows(rules.quarantine(wh)) != []
    assert rows(found.select(cells)) == rows(wh.typed.select(cells)) and found.where("rule_ids IS NULL AND raw_json IS NOT NULL").count() == 0

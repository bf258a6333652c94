import datetime as dt
import random
import tempfile

from pyspark.sql import functions as F

from conftest import log_row, tabs_from
from ledgerflow.operators.cdc import apply_soft_delete, initial_state, snapshot_diff, with_source_row_id
from ledgerflow.operators.dedup import near_duplicates
from ledgerflow.plans import rules
from ledgerflow.plans.pipeline import TradingModel, run
from ledgerflow.plans.warehouse import Warehouse
from ledgerflow.sources import state

T = [dt.datetime(2026, 6, d, 6) for d in (1, 2, 3)]


def _ids(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "source_row_id string")


def test_soft_delete_lifecycle(spark):
    s1 = initial_state(_ids(spark, ["a", "b", "c"]), "L1", T[0])
    s2 = apply_soft_delete(s1, _ids(spark, ["a", "c", "d"]), "L2", T[1])
    got2 = {r.source_row_id: r for r in s2.collect()}
    assert got2["b"].is_deleted and got2["b"].deleted_by_load_id == "L2" and got2["b"].change == "deleted"
    assert got2["d"].change == "inserted" and not got2["d"].is_deleted
    s3 = apply_soft_delete(s2.drop("change"), _ids(spark, ["a", "b"]), "L3", T[2])
    got3 = {r.source_row_id: r for r in s3.collect()}
    assert got3["b"].change == "reactivated" and not got3["b"].is_deleted and got3["b"].deleted_at is None
    assert got3["c"].change == "deleted" and got3["d"].change == "deleted"
    assert got3["a"].last_seen_load_id == "L3"


def test_snapshot_diff(spark):
    d = {r.source_row_id: r.status for r in snapshot_diff(_ids(spark, ["a", "b"]), _ids(spark, ["b", "c"])).collect()}
    assert d == {"a": "deleted", "b": "kept", "c": "new"}


def test_fingerprint_collision_gets_row_suffix(spark):
    df = spark.createDataFrame([("x", "1", 2), ("x", "1", 3), ("y", "1", 4)], "a string, b string, source_row_number int")
    ids = [r.source_row_id for r in with_source_row_id(df, "s", "T", ["a", "b"]).collect()]
    copies = sorted(i for i in ids if ":row" in i)
    assert len(copies) == 2 and copies[0].endswith(":row2") and copies[1].endswith(":row3")
    assert len({i.rsplit(":row", 1)[0] for i in copies}) == 1 and len(set(ids)) == 3


def test_near_duplicates_match_brute_force(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, rnd.choice("ab"), base + dt.timedelta(seconds=rnd.randint(0, 20000))) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp")
    got = {r.id for r in near_duplicates(df, ["k"], "ts", 60)
           .where("is_near_duplicate").collect()}
    expect = {i for i, k, t in rows
              if any(j != i and k2 == k and abs((t2 - t).total_seconds()) <= 60 for j, k2, t2 in rows)}
    assert got == expect


def test_rule_engine_flags_and_quarantine(spark):
    rows = [log_row("2026-06-10 09:00:00", "Purchase", vendor="V", qty=("abc", "", "", "", "")),
            log_row("2026-06-10 09:01:00", "Sale", vendor="V", customer="C", payment="-5", mode="Card")]
    tabs = tabs_from(spark, rows)
    raw = tabs["transaction_log"].withColumn(
        "source_row_number", F.when(F.col("timestamp").endswith("09:01:00"), F.lit(3)).otherwise(F.lit(2)))
    wh = Warehouse(raw, tabs["vendor_rates"], tabs["customer_rates"], dt.date(2026, 6, 30))
    v = {(r.rule_id, r.severity) for r in rules.violations(wh).collect()}
    assert ("stg_txn_qty_not_numeric", "error") in v and ("stg_txn_noop_row", "error") in v
    assert ("stg_txn_payment_mode_invalid", "error") in v and ("stg_txn_vendor_on_sale", "warning") in v
    q = rules.quarantine(wh).collect()
    assert len(q) == 2 and all(r.rule_ids for r in q)
    summary = {r.check_id: r.violating_rows for r in rules.validation_summary(wh).collect()}
    assert summary["quality_negative_payment"] == 1 and summary["overall"] == 2


def test_pipeline_run_writes_marts(spark):
    rows = [log_row("2026-06-10 09:00:00", "Purchase", vendor="V", qty=("2", "", "", "", ""), payment="50"),
            log_row("2026-06-12 09:00:00", "Purchase", vendor="V", qty=("1", "", "", "", ""))]
    vr = [("2026-06-01", "V", "100", "", "", "", "", "")]
    m = TradingModel(tabs_from(spark, rows, vr), dt.date(2026, 6, 30))
    out = tempfile.mkdtemp(prefix="ledgerflow-run-")
    paths = run(spark, m, out)
    daily = spark.read.parquet(paths["mart_daily_metrics"])
    assert daily.count() == 3
    last = daily.orderBy(F.col("date").desc()).first()
    assert float(last.outstanding_payable) == 250.0


def test_state_guard(spark):
    prev = spark.createDataFrame([("log", 10), ("rates", 5)], "table_name string, row_count long")
    cur = spark.createDataFrame([("log", 12), ("rates", 5)], "table_name string, row_count long")
    d = state.row_count_delta(prev, cur).collect()
    assert [(r.table_name, r.row_delta) for r in d] == [("log", 2)]
    assert state.should_run(prev, prev).first().run is False
    assert state.should_run(prev, cur).first().run is True
    path = tempfile.mkdtemp(prefix="ledgerflow-state-") + "/state"
    state.save_state(cur, path)
    assert sorted(tuple(r) for r in state.load_state(spark, path).collect()) == [("log", 12), ("rates", 5)]

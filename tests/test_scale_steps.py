"""Steps that every trading query shares: what they write and shuffle."""
import contextlib
import datetime as dt
import glob
import io
import os
import re
import time

from conftest import LOG_COLUMNS, log_row, tabs_from
from pyspark.sql import functions as F

from ledgerflow import config
from ledgerflow.functions.expr import blank_to_null, parse_date, parse_timestamp, strip_all_whitespace
from ledgerflow.operators import cdc
from ledgerflow.operators.asof import asof_join
from ledgerflow.plans import analytics, marts, rollups, rules, store
from ledgerflow.plans.lifecycle import LoadHistory
from ledgerflow.plans.pipeline import TradingModel
from ledgerflow.plans.warehouse import Warehouse
from ledgerflow.sources import fixtures, tabs

RATES = [("2026-06-01", "Ravi", "100", "150", "80", "40", "60", "")]
CUSTOMERS = [("2026-06-01", "Hotel", "200", "250", "120", "90", "100", "")]
ROWS = [log_row("2026-06-02 09:00:00", "Purchase", "Ravi", payment="10", qty=("1", "2", "", "", "")), log_row("2026-06-03 09:00:00", "Sale", "", "Hotel", payment="20", qty=("3", "", "", "", "")),
        log_row("2026-05-03 09:00:00", "Sale", "", "HOTEL", qty=("3", "", "", "", "")), log_row("2026-06-03 09:00:00", "Sale", "", "Nobody", qty=("1", "", "", "", ""))]


def plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_cells_are_stripped_without_a_regular_expression(spark):
    cells = [" \t a b 　\n", "", " ", "x", None, " a​"]
    df = spark.createDataFrame([(c,) for c in cells], "c string").select("c", strip_all_whitespace("c").alias("s"))
    assert [r.s for r in df.collect()] == ["a b", "", "", "x", None, "a​"] and "regexp" not in plan(df)


def test_rows_are_hashed_into_a_stage_and_only_repeated_hashes_are_joined(spark):
    stages = {}

    def stage(name, build):
        stages[name] = build()
        return stages[name]

    df = spark.createDataFrame([("a", 2), ("b", 3), ("a", 4), (None, 5)], "c string, source_row_number long")
    ids = [r.source_row_id for r in cdc.with_source_row_id(df, "s", "T", ["c"], stage=stage).orderBy("source_row_number").collect()]
    assert [":row" in i for i in ids] == [True, False, True, False]
    assert stages["copies"].count() == 1 and "content_fingerprint" in stages["fingerprinted"].columns


def test_a_quarterly_price_is_written_out_once_for_the_join(spark):
    prices = [("v", dt.date(2026, 1 + 3 * q, 1), q) for q in range(4)]
    lines = [("v", dt.date(2026, m, d)) for m in range(1, 13) for d in (1, 28)] + [("v", dt.date(2025, 12, 31)), ("w", dt.date(2026, 1, 1)), ("v", None)]
    left, right = spark.createDataFrame(lines, "k string, d date"), spark.createDataFrame(prices, "k string, f date, p int")
    out = asof_join(left, right, ["k"], "d", "f")
    assert "quarter(" in out._jdf.queryExecution().analyzed().toString()
    assert all(r.p == ((r.d.month - 1) // 3 if r.k == "v" and r.d and r.d.year == 2026 else None) for r in out.collect()) and out.count() == len(lines)


def test_lines_of_the_log_are_dealt_once(spark):
    text = plan(fixtures.raw_transaction_log(spark, "/root/testdata/sf0.001"))
    assert "hashpartitioning(l_orderkey" in text and "hashpartitioning(l_orderkey#" in text and ", supp#" not in "".join(ln for ln in text.splitlines() if "Exchange" in ln)


def test_a_state_comes_straight_from_the_lines(spark):
    m = TradingModel(tabs_from(spark, ROWS, RATES, CUSTOMERS), dt.date(2026, 6, 30))
    full = rollups.full_state(m.allocated)
    for level in rollups.LEVELS:
        again = full if level == "full" else rollups.roll_up(full, level)
        rows = lambda df: sorted(map(str, df.select(*again.columns).collect()))
        assert rows(rollups.state_of(m.allocated, level)) == rows(again) != []


def test_a_first_load_writes_its_rows_once(spark, tmp_path):
    tabs, root = tabs_from(spark, [], RATES, CUSTOMERS), str(tmp_path / "s")
    log = spark.createDataFrame([(*r, 2 + i) for i, r in enumerate([*ROWS, ROWS[0]])] + [(*ROWS[1], 3)], ", ".join(f"{c} string" for c in LOG_COLUMNS) + ", source_row_number long")
    h = LoadHistory(spark, root, dt.date(2026, 6, 30), 4)
    h.load("a", dt.datetime(2026, 6, 29), log, tabs["vendor_rates"], tabs["customer_rates"])
    assert not os.path.exists(f"{root}/stages/rows-1") and not os.path.exists(f"{root}/stages/touched-1")
    assert h.tables["rows"].read().groupBy("source_row_id").count().where("count > 1").count() == 0 and h.tables["rows"].read().count() == 5
    facts = h.facts("fact_inventory")
    assert {r.rate_lookup_status for r in facts.collect()} == {"matched", "missing_counterparty"}
    assert facts.where(F.col("ingested_at") != F.lit("2026-06-29").cast("timestamp_ntz")).count() == 0 and facts.where("is_deleted").count() == 0


def test_plain_times_are_cast_and_read_as_the_formats_read_them(spark):
    texts = ["2001-02-30 10:00:00", "2001-13-01 10:00:00", "2001-12-31 24:00:00", "2001-12-31 23:59:60", "1582-10-10 01:02:03", "0000-01-01 00:00:00", "2000-02-29 00:00:00",
             " 2001-01-01 00:00:00 ", "2001-01-01 00:00:00\n", "2001-1-1 1:1:1", "2001-01-01T00:00:00", "30/01/2001 03:04:05", "02/01/2001 03:04:05", "", None]
    by_format = lambda s, f: F.coalesce(*[F.try_to_timestamp(s, F.lit(x)) for x in f])
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    times = df.select(parse_timestamp("c").cast("string").alias("new"), by_format(F.trim("c"), config.TIMESTAMP_FORMATS).cast("string").alias("old"))
    days = df.select(F.split("c", "[ T]")[0].alias("c")).select(parse_date("c").cast("string").alias("new"), by_format(blank_to_null("c"), config.DATE_FORMATS).cast("date").cast("string").alias("old"))
    assert [r.new for r in times.collect()] == [r.old for r in times.collect()] and [r.new for r in days.collect()] == [r.old for r in days.collect()]
    assert times.where("new IS NOT NULL").count() == 7 and "rlike" in plan(times).lower() and "rlike" in plan(days).lower()


def test_blank_rows_are_dropped_without_stripping_their_cells_twice(spark):
    df = spark.range(1).select(F.lit(" 　").alias("a"), F.lit("\t").alias("b"), F.lit(2).cast("long").alias("source_row_number")).unionByName(
        spark.range(1).select(F.lit(None).cast("string").alias("a"), F.lit(" x ").alias("b"), F.lit(3).cast("long").alias("source_row_number")))
    assert [(r.a, r.b) for r in tabs.clean_cells(df).collect()] == [("", "x")]
    cells = spark.createDataFrame([("a", "b")], "a string, b string")
    steps = tabs.clean_cells(cells)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert [ln.count("trim(") for ln in steps if "Filter" in ln] == [1]


def test_the_typed_log_is_written_once_and_a_calendar_does_not_ask_for_it(spark):
    tabs_, stages = tabs_from(spark, ROWS, RATES, CUSTOMERS), []

    def stage(name, build):
        stages.append(name)
        return build()

    log = spark.createDataFrame([(*r, 2 + i) for i, r in enumerate(ROWS)], ", ".join(f"{c} string" for c in LOG_COLUMNS) + ", source_row_number long")
    wh = Warehouse(log, tabs_["vendor_rates"], tabs_["customer_rates"], dt.date(2026, 6, 30), stage=stage)
    assert wh.dim_date.count() > 365 and "typed_log" not in stages
    assert wh.fact_payment.count() == 2 and wh.fact_inventory.count() == 5 and stages.count("typed_log") == 1


def test_a_form_is_shuffled_for_all_its_lines_and_rated_like_them(spark):
    """Forms, not lines, go to the rates and to their key; rows and shares are those of ``allocated_lines``."""
    rates = [("2026-05-01", "Ravi", "90", "", "80", "40", "60", ""), *RATES, ("2026-06-01", "Ravi", "101", "", "", "", "", "")]
    rows = [*ROWS, *[log_row("2026-06-02 09:00:00", "Purchase", "Ravi", payment="10", mode=m, qty=q, date=d) for m, q, d in (
                ("Online", ("5", "", "1", "", ""), "2026-05-20"), ("", ("", "", "2", "", "7"), "2026-05-01"), ("Cash", ("", "", "", "", ""), ""))],
            log_row("2026-06-02 09:00:00", "Return", "Ravi", payment="4", qty=("1", "", "", "", "1")), log_row("n/a", "Sale", "", "Hotel", payment="5", qty=("2", "", "", "", "")),
            log_row("2026-06-02 09:00:00", "", "", "", qty=("", "3", "", "", "")), log_row("2020-01-01 09:00:00", "Purchase", "Ravi", qty=("1", "", "", "", "")),
            log_row("2026-06-04 09:00:00", "Purchase", "Ravi|C", payment="1", qty=("1", "", "", "", "")), log_row("2026-06-05 09:00:00", "Sale", "", "Hotel", payment="7")]
    m = TradingModel(tabs_from(spark, rows, rates, CUSTOMERS), dt.date(2026, 6, 30))
    lines = marts.allocated_lines(m.items, m.chosen_rates, m.payments)
    found = lambda df: sorted(map(str, df.collect()))
    assert m.allocated.columns == lines.columns and found(m.allocated) == found(lines)
    assert found(m.enriched) == found(analytics.value_lines(m.items, m.chosen_rates))
    assert {r.applicable_rate for r in m.allocated.where("product_name = 'Mushroom Bulk' AND date = '2026-05-20'").collect()} == {101}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_key, by_line = (re.findall(r"Exchange hashpartitioning\((\w+)", plan(df.select("*"))) for df in (m.allocated, lines))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert by_key.count("transaction_key") == 2 < by_line.count("transaction_key")


def _shuffle_files(spark):
    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in folders for f in glob.glob(f"{d.getPath()}/*/shuffle_*.data")}


def test_shuffle_files_of_a_written_stage_go_at_once(spark, monkeypatch):
    monkeypatch.setattr(store, "FREE_AFTER_S", 0, raising=False)
    before = _shuffle_files(spark)
    store.stage(spark, "freed", lambda: spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    until = time.monotonic() + 10
    while _shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before


def test_what_lies_between_the_shuffles_of_a_stage_is_deleted_with_them(spark):
    t = tabs_from(spark, [*ROWS, ROWS[0], log_row("n/a", "Sale", "", "Hotel", payment="5", qty=("2", "", "", "", ""))], RATES, CUSTOMERS)
    m, staged = TradingModel(t, dt.date(2026, 6, 30)), TradingModel(t, dt.date(2026, 6, 30), spark, "passing-test")
    written = []
    marts.allocated_forms(m.stg_log, m.items, m.payments, m.rates, (), lambda name, build: written.append(name) or build()).count()
    assert written == ["intervals", "dated"]
    assert sorted(map(str, staged.allocated.collect())) == sorted(map(str, m.allocated.collect())) != []
    assert not glob.glob(f"{store.scratch_root(spark)}/run-*/passing-*")


def test_rates_meet_forms_before_lines_are_written_out(spark):
    t = tabs_from(spark, [*ROWS, log_row("n/a", "Sale", "", "Hotel", qty=("2", "", "", "", "1")), log_row("2026-06-02 09:00:00", "Return", "Ravi", qty=("1", "", "", "", ""))], RATES, CUSTOMERS)
    wh = Warehouse(t["transaction_log"].withColumn("source_row_number", F.monotonically_increasing_id()), t["vendor_rates"], t["customer_rates"], dt.date(2026, 6, 30))
    dated = wh._dated_lines()
    asked = asof_join(wh.lines, wh.rates, ["side", "counterparty"], "transaction_date", "effective_from", tiebreak=list(config.RATE_COLUMNS))
    want = asked.withColumn("rate_rs", analytics.pick_by_name("product_name", analytics.RATE_BY_PRODUCT)).select(dated.columns)
    assert sorted(map(str, dated.collect())) == sorted(map(str, want.collect())) and dated.count() == 8
    text = plan(dated)
    assert 0 <= text.index("Generate inline") < text.index("Join")  # read from the top: lines are written out after the join


def test_only_rows_that_share_a_fingerprint_are_shuffled_for_ingest_findings(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4), ("d", None), ("d", 5), ("e", None)], "c string, source_row_number long")
    rows = cdc.with_source_row_id(df, "s", "T", ["c"])
    lone, repeated = cdc.lone_and_repeated(rows, "s", "T")
    assert sorted(r.c for r in lone.collect()) == ["a", "c", "e"] and sorted(r.c for r in repeated.collect()) == ["b", "b", "d", "d"]
    loads = ["source_row_number <> 1 AND source_row_number <> 3", "source_row_number <> 4", "TRUE"]
    ids = lambda of, load: cdc.assign_source_row_id(of.where(load), "s", "T").select("source_row_id")
    present = [F.coalesce(F.expr(p), F.lit(False)).alias(f"in{i}") for i, p in enumerate(loads, 1)]
    known = lone.select("source_row_id", *present)
    found = lambda out: sorted(map(str, out.collect()))
    whole = rules.ingest_violations(*[ids(rows, p) for p in loads])
    split = rules.ingest_violations(*[ids(repeated, p) for p in loads], known)
    assert found(split) == found(whole) and len(found(whole)) > 2

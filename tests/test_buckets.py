import datetime as dt

import pytest
from conftest import LOG_COLUMNS, log_row, tabs_from

from ledgerflow import config
from ledgerflow.operators import buckets
from ledgerflow.plans.daily_run import daily_run
from ledgerflow.sources import tabs


def changed(a, b):
    return sorted(r.bucket for r in buckets.changed(buckets.digests(a, ["k"]), buckets.digests(b, ["k"])).collect())


def test_digests_see_every_change_and_no_order(spark):
    rows = [(f"k{i % 40}", str(i), None if i % 5 else "") for i in range(200)]
    df = lambda r: spark.createDataFrame(r, "k string, a string, b string")
    base = df(rows).repartition(7)
    home = {r.k: r.b for r in base.select("k", buckets.bucket_of(["k"]).alias("b")).distinct().collect()}
    assert changed(base, df(rows[::-1])) == []
    assert changed(base, df([("k3", "edited", None) if r[1] == "3" else r for r in rows])) == [home["k3"]]
    assert changed(base, df(rows + [rows[9]])) == [home["k9"]] and changed(base, df(rows[1:])) == [home["k0"]]
    assert changed(base, df([(r[0], r[1], "") if r[1] == "7" else r for r in rows])) == [home["k7"]]  # NULL is not blank
    swapped = [(r[0], {"0": "40", "40": "0"}.get(r[1], r[1]), r[2]) for r in rows]
    assert changed(base, df(swapped)) == [home["k0"]] or rows[0][2] == rows[40][2]
    assert changed(base, df([])) == sorted(set(home.values()))


def test_only_named_buckets_are_written(spark, tmp_path):
    df = lambda v: buckets.with_bucket(spark.createDataFrame([(f"k{i}", v) for i in range(50)], "k string, v string"), ["k"])
    path = str(tmp_path / "t")
    buckets.write(df("old"), path)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    some = sorted({r.bucket for r in df("x").select("bucket").distinct().collect()})[:3]
    buckets.write(df("new"), path, some)
    got = {r.bucket: r.v for r in buckets.read(spark, path).select("bucket", "v").distinct().collect()}
    assert all(v == ("new" if b in some else "old") for b, v in got.items())
    kept = [p for p in files if p.exists() and int(p.parent.name.split("=")[1]) not in some]
    assert len(kept) == len(files) - 3 and all(p.stat().st_mtime_ns == files[p] for p in kept)


@pytest.fixture
def source(spark):
    def make(edit=None, drop=()):
        rows = [log_row(f"2026-06-{1 + i % 20:02d} 09:{i % 60:02d}:00", "Purchase", vendor="V", payment=str(i), qty=(str(1 + i), "", "", "", "")) for i in range(60) if i not in drop]
        rows = [tuple(edit.get(c, v) for c, v in zip(LOG_COLUMNS, r)) if edit and i == 7 else r for i, r in enumerate(rows)]
        return tabs_from(spark, [*rows, tuple(" " for _ in LOG_COLUMNS)], [("2026-06-01", "V", "100", "1", "1", "1", "1", "")])
    return make


def test_an_edit_in_place_reloads_its_bucket(spark, tmp_path, source):
    out, day = str(tmp_path), dt.date(2026, 6, 30)
    amount = lambda run: spark.read.parquet(run["marts"]["mart_daily_metrics"]).agg({"purchase_amount": "sum"}).first()[0]
    first = daily_run(spark, source(), out, day)
    assert not first["skipped"] and first["load"]["transaction_log"] == {"rows": 60, "blank_rows": 1} and first["row_delta"] == {"transaction_log": 60, "vendor_rates": 1, "customer_rates": 0}
    before = amount(first)
    raw = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "raw" / "transaction_log").rglob("*.parquet")}
    files = raw()
    again = daily_run(spark, source(), out, day)
    assert again["skipped"] and again["changed_buckets"] == {} and raw() == files
    edited = daily_run(spark, source(edit={"mushroom_bulk_qty_kg": "9"}), out, day)
    assert not edited["skipped"] and edited["row_delta"] == {"transaction_log": 0}  # counts alone would have missed it
    assert [len(b) for b in edited["changed_buckets"].values()] == [1] and amount(edited) - before == 100
    assert len([p for p, t in raw().items() if files.get(p) == t]) == len(files) - 1
    fewer = daily_run(spark, source(drop=range(0, 60, 20)), out, day)  # whole buckets may be gone
    assert fewer["row_delta"]["transaction_log"] == -3
    columns = list(dict.fromkeys(config.TAB_COLUMN_MAPS["transaction_log"].values()))
    assert tabs.loaded(spark, f"{out}/raw/transaction_log", columns, rejected=True).count() >= 1
    assert daily_run(spark, source(drop=range(0, 60, 20)), out, day, force=True)["load"]["transaction_log"]["rows"] == 57


def test_findings_of_a_load(spark, tmp_path, source):
    cmap = config.TAB_COLUMN_MAPS["transaction_log"]
    heads = list(cmap)
    (tmp_path / "log.csv").write_text(",".join([*heads[:-1], "Surprise"]) + "\n" + "a" + "," * len(heads) + "\n" + " ," * len(heads) + "\n")
    found = tabs.header_findings(spark, tabs.export_headers(spark, str(tmp_path / "log.csv"), "csv"), cmap, "log")
    assert sorted(map(tuple, found.collect())) == [("ingest_schema_column_missing", "error", "log", "Remarks"), ("ingest_schema_extra_column", "warning", "log", "Surprise")]
    df = tabs.read_tab_export(spark, str(tmp_path / "log.csv"), cmap, strict=False)
    metrics = tabs.load_tab(df, "transaction_log", str(tmp_path / "raw"))
    assert metrics == {"rows": 1, "blank_rows": 1}
    side = tabs.loaded(spark, str(tmp_path / "raw"), df.columns, rejected=True)
    assert [r.rule_id for r in tabs.ingest_findings(spark, "log", metrics, side).collect()] == ["ingest_row_empty"]
    empty = tabs.load_tab(df.where("timestamp <> 'a'"), "transaction_log", str(tmp_path / "raw2"))
    rules = [r.rule_id for r in tabs.ingest_findings(spark, "log", empty, tabs.loaded(spark, str(tmp_path / "raw2"), df.columns, rejected=True)).collect()]
    assert sorted(rules) == ["ingest_empty_sheet", "ingest_row_empty"]

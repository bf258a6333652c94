import contextlib
import datetime as dt
import io
import random

import pytest
from conftest import LOG_COLUMNS, log_row, tabs_from
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerflow.operators.asof import _range_of, asof_ranges, equi_depth_borders
from ledgerflow.operators.dedup import near_duplicates
from ledgerflow.operators.prefix import running_sums
from ledgerflow.plans.names import canonical_names, rated_by_name
from ledgerflow.plans.warehouse import Warehouse


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def events(seed, n=400):
    """One user holds half of the rows; many rows share a second; some users have no view, some times are NULL."""
    rnd = random.Random(seed)
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 200))
    return [(i, "hot" if i % 2 else rnd.choice("abc") if i % 10 else None, None if i % 37 == 0 else at()) for i in range(n)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_asof_over_ranges_equals_brute_force(spark, kind, ranges):
    left, right = events(1), events(2, 150)
    l = spark.createDataFrame(left, f"id int, user string, ts {kind}").repartition(3)
    r = spark.createDataFrame(right, f"seen int, user string, seen_ts {kind}").repartition(3)
    got = {x.id: (x.seen, x.seen_ts) for x in asof_ranges(l, r, ["user"], "ts", "seen_ts", ["seen"], ranges).collect()}
    for i, user, ts in left:
        best = max(((t, s) for s, u, t in right if u == user and user is not None and t is not None and ts is not None and t <= ts), default=(None, None))
        assert got[i] == best[::-1], (i, user, ts)
    assert len(got) == len(left)


def test_a_hot_user_is_split_by_time(spark):
    one = spark.range(4000).select(F.timestamp_seconds(F.col("id") % 50).alias("ts"))
    borders = equi_depth_borders(one, ranges=8)
    sizes = sorted(r["count"] for r in one.groupBy(_range_of(F.unix_micros("ts"), borders)).count().collect())
    assert len(sizes) >= 7 and sizes[-1] < 4000 / 4
    assert equi_depth_borders(one.where("false"), ranges=8) == []


def test_running_sums_in_two_levels(spark):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") / 3).cast("int")).alias("d"), (F.col("id") * 7 % 11 - 5).alias("v"))
    got = running_sums(df, ["k"], "d", F.trunc("d", "month"), {"s": F.col("v"), "n": F.lit(1)})
    w = Window.partitionBy("k").orderBy("d").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = df.select("*", F.sum("v").over(w).alias("s"), F.count("*").over(w).alias("n"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_near_duplicates_read_their_input_twice(spark, tmp_path):
    spark.createDataFrame([(i, "a", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=100 * i)) for i in range(20)], "id int, k string, ts timestamp").write.parquet(f"{tmp_path}/e")
    plan = plan_of(near_duplicates(spark.read.parquet(f"{tmp_path}/e"), ["k"], "ts"))
    assert plan.count("FileScan") == 2


def test_names_in_other_spellings_are_matched(spark):
    day = "2026-06-10 09:00:00"
    q = ("1", "", "", "", "")
    rows = [log_row(day, "Purchase", n, qty=q) for n in ("Ravi", "ravi", "RAVI  kumar", "Nobody", "Late", "late ")]
    rates = [("2026-06-01", "Ravi", "100", "", "", "", "", ""), ("2026-06-05", "Ravi", "105", "", "", "", "", ""), ("2026-06-09", "RAVI", "109", "", "", "", "", ""),
             ("2026-06-02", "Ravi Kumar", "50", "", "", "", "", ""), ("2026-06-20", "Late", "1", "", "", "", "", ""), ("2026-06-03", "LATE", "7", "", "", "", "", ""),
             ("2026-06-02", "ravi kumar", "60", "", "", "", "", ""), ("2026-06-01", "Ravi Kumar", "40", "", "", "", "", "")]
    tabs = tabs_from(spark, [], rates)
    log = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ", ".join(f"{c} string" for c in LOG_COLUMNS) + ", source_row_number long")
    wh = Warehouse(log, tabs["vendor_rates"], tabs["customer_rates"], dt.date(2026, 6, 30))
    got = {r.counterparty: (r.rate_rs, r.rate_lookup_status, r.rate_name, r.name_mismatch) for r in rated_by_name(wh).collect()}
    assert got["Ravi"] == (105, "matched", "Ravi", False)  # its own spelling first, although another has a newer row
    assert got["ravi"] == (109, "matched", "RAVI", True)
    assert got["RAVI  kumar"] == (50, "matched", "Ravi Kumar", True)  # two rows of one day: the canonical spelling
    assert got["Nobody"] == (None, "missing_counterparty", None, False)
    assert got["Late"] == (7, "matched", "LATE", True) and got["late"] == (7, "matched", "LATE", True)  # own rate only begins later
    canon = {r.normal_name: (r.canonical_name, r.spellings) for r in canonical_names(wh.rates).collect()}
    assert canon == {"ravi": ("Ravi", 2), "ravi kumar": ("Ravi Kumar", 2), "late": ("Late", 2)}

import contextlib
import datetime as dt
import io
import re

import pytest
from conftest import log_row, tabs_from

from ledgerflow.operators import skew
from ledgerflow.plans import marts
from ledgerflow.plans.pipeline import TradingModel

RUN = dt.date(2026, 6, 30)


def final_plan(df):
    """The plan that was run (adaptive, after execution)."""
    df.collect()
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    text = out.getvalue()
    return text.split("== Initial Plan ==")[0]


def tabs(spark):
    """A third of the forms cannot be read (no time, no names): they share one key."""
    rows = []
    for i in range(90):
        if i % 3 == 0:
            rows.append(log_row("unreadable", "Purchase", payment="70", qty=(str(1 + i % 4), "", "2", "", "")))
        else:
            rows.append(log_row(f"2026-06-{1 + i % 25:02d} 09:{i % 60:02d}:00", "Purchase" if i % 2 else "Sale", vendor="V" if i % 2 else "", customer="" if i % 2 else "C",
                                payment=str(10 * (i % 7)), qty=(str(i % 5), "1", "", "", str(i % 2))))
    rates = [("2026-06-01", "V", "100", "150", "80", "40", "60", ""), ("2026-06-10", "V", "101", "", "0", "40", "60", "")]
    return tabs_from(spark, rows, rates, [("2026-06-05", "C", "200", "250", "120", "90", "100", "")])


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_heavy_keys_by_buckets(spark):
    df = spark.createDataFrame([("hot",)] * 700 + [(f"k{i}",) for i in range(900)] + [(None,)] * 400, "k string").repartition(4)
    assert skew.heavy_keys(df, "k", min_rows=10) == ["hot"]
    assert skew.heavy_keys(df, "k") == []  # too few rows to matter
    assert skew.heavy_keys(df.where("k <> 'hot'"), "k", min_rows=10) == []


@pytest.mark.parametrize("how", ["left", "inner"])
def test_split_join_equals_join(spark, how):
    left = spark.createDataFrame([("hot", i) for i in range(50)] + [("a", 1), ("b", 2), (None, 3), ("only", 4)], "k string, v int")
    right = spark.createDataFrame([("hot", "x"), ("a", "y"), ("b", "z"), ("b", "zz"), (None, "n")], "k string, w string")
    assert rows_of(skew.split_join(left, right, "k", ["hot", "only"], how)) == rows_of(left.join(right, "k", how))


def test_allocation_with_a_heavy_key(spark, monkeypatch):
    plain = TradingModel(tabs(spark), RUN)
    assert plain.heavy_keys == []
    monkeypatch.setattr(skew, "MIN_ROWS", 5)
    hot = TradingModel(tabs(spark), RUN)
    hot.heavy_keys = skew.heavy_keys(hot.items, "transaction_key", min_rows=5)
    assert len(hot.heavy_keys) == 1
    assert rows_of(hot.allocated) == rows_of(plain.allocated)
    assert rows_of(hot.enriched) == rows_of(plain.enriched)
    (copies,) = {r.copies for r in hot.allocated.where(hot.allocated.transaction_key == hot.heavy_keys[0]).collect()}
    assert copies == 30 and hot.mart_transactions.count() == plain.mart_transactions.count() > 60 * 30


def test_one_shuffle_of_the_lines_and_none_of_heavy_ones(spark):
    m = TradingModel(tabs(spark), RUN)
    chosen = spark.createDataFrame(m.chosen_rates.collect(), m.chosen_rates.schema)  # a written stage in a run
    heavy = skew.heavy_keys(m.items, "transaction_key", min_rows=5)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffles = lambda keys: len(re.findall(r"Exchange hashpartitioning\(transaction_key", final_plan(marts.allocated_lines(m.items, chosen, m.payments, keys))))
        plain, split = shuffles([]), shuffles(heavy)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plain == 3  # lines, rates, payments: once each
    # the heavy keys add their few rates, totals and payments, aggregated before they move, but not their lines
    assert split <= plain + 3, split


@pytest.mark.parametrize("copies", [1, 2, 4096, 4097, 10000])
def test_copies_are_written_out_in_blocks(spark, copies):
    columns = ", ".join(f"{c} string" for c in marts.MART_TRANSACTIONS_COLUMNS)
    df = spark.createDataFrame([(*["x"] * len(marts.MART_TRANSACTIONS_COLUMNS), copies)], f"{columns}, copies long")
    assert marts.mart_transactions(df).count() == copies

import datetime as dt
import random

import pandas as pd

from ledgerflow.operators.asof import asof_join


def test_golden_rate_selection(spark):
    """Rates 120/130/140 from 06-01/06-05/06-15: the 06-10 lookup picks 130."""
    rates = spark.createDataFrame(
        [("x", dt.date(2026, 6, 1), 120.0), ("x", dt.date(2026, 6, 5), 130.0), ("x", dt.date(2026, 6, 15), 140.0)],
        "k string, effective_from date, rate_rs double")
    left = spark.createDataFrame([("x", dt.date(2026, 6, 10))], "k string, d date")
    out = asof_join(left, rates, ["k"], "d", "effective_from").collect()
    assert [r.rate_rs for r in out] == [130.0]


def _brute(left, right):
    rows = []
    for _, l in left.iterrows():
        cand = right[(right.k == l.k) & (right.effective_from <= l.d)] if l.d is not None else right.iloc[0:0]
        if len(cand):
            best = cand.sort_values(["effective_from", "v"]).iloc[-1]
            rows.append((l.id, best.v))
        else:
            rows.append((l.id, None))
    return sorted(rows, key=lambda r: r[0])


def test_asof_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.date(2019, 12, 1)
    right = [(rnd.choice("abc"), base + dt.timedelta(days=rnd.randint(0, 900)), float(i)) for i in range(120)]
    right += [("a", right[0][1], 999.0)]  # a tie on effective_from
    left = [(i, rnd.choice("abcd"), None if i % 17 == 0 else base + dt.timedelta(days=rnd.randint(-30, 1000)))
            for i in range(400)]
    rdf = spark.createDataFrame(right, "k string, effective_from date, v double")
    ldf = spark.createDataFrame(left, "id int, k string, d date")
    got = sorted(((r.id, r.v) for r in asof_join(ldf, rdf, ["k"], "d", "effective_from", tiebreak=["v"]).collect()),
                 key=lambda r: r[0])
    expect = _brute(pd.DataFrame(left, columns=["id", "k", "d"]),
                    pd.DataFrame(right, columns=["k", "effective_from", "v"]))
    assert got == expect


def test_asof_keeps_every_left_row_once(spark):
    rates = spark.createDataFrame([("x", dt.date(2020, 1, 1), 1.0), ("x", dt.date(2023, 1, 1), 2.0)],
                                  "k string, effective_from date, v double")
    left = spark.createDataFrame([(i, "x", dt.date(2019, 6, 1) + dt.timedelta(days=40 * i)) for i in range(60)],
                                 "id int, k string, d date")
    out = asof_join(left, rates, ["k"], "d", "effective_from").collect()
    assert len(out) == 60 and len({r.id for r in out}) == 60

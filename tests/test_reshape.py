import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerflow.operators.reshape import clip, days_in, densify, densify_running, running_intervals
from ledgerflow.plans.marts import balances_in


def test_densify_matches_spine_join(spark):
    rnd = random.Random(3)
    base = dt.date(2024, 1, 1)
    rows = {}
    for _ in range(300):
        e = rnd.choice(["a", "b", "c", "d"])
        d = base + dt.timedelta(days=rnd.randint(0, 60))
        rows[(e, d)] = rnd.randint(-50, 100)
    sparse = spark.createDataFrame([(e, d, v) for (e, d), v in rows.items()], "e string, date date, flow long")
    got = {(r.e, r.date): (r.flow, r.bal) for r in
           densify_running(sparse, ["e"], "date", ["flow"], {"bal": F.col("flow")}).collect()}
    lo, hi = min(d for _, d in rows), max(d for _, d in rows)
    ents = sorted({e for e, _ in rows})
    expect = {}
    for e in ents:
        bal = 0
        d = lo
        while d <= hi:
            f = rows.get((e, d), 0)
            bal += f
            expect[(e, d)] = (f, bal)
            d += dt.timedelta(days=1)
    assert got == expect


def test_densify_company_level_no_partition(spark):
    sparse = spark.createDataFrame([(dt.date(2024, 1, 1), 5), (dt.date(2024, 1, 4), 7)], "date date, flow long")
    out = sorted((r.date.day, r.flow, r.bal) for r in
                 densify_running(sparse, [], "date", ["flow"], {"bal": F.col("flow")}).collect())
    assert out == [(1, 5, 5), (2, 0, 5), (3, 0, 5), (4, 7, 12)]


def _random_days(spark, seed=5):
    rnd = random.Random(seed)
    rows = {(rnd.choice("abcdef"), dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randint(0, 90))): (rnd.randint(-50, 100), rnd.randint(0, 9)) for _ in range(80)}
    return spark.createDataFrame([(e, d, *v) for (e, d), v in rows.items()], "e string, date date, flow long, other long")


def test_intervals_tile_the_calendar_and_answer_like_day_rows(spark):
    sparse = _random_days(spark)
    args = (["e"], "date", ["flow", "other"], {"bal": F.col("flow") - F.col("other")})
    intervals, dense = running_intervals(sparse, *args), densify_running(sparse, *args)
    entities = sparse.select("e").distinct().count()
    assert intervals.count() <= sparse.count() + entities
    assert intervals.agg(F.sum(days_in())).first()[0] == dense.count()
    for lo, hi in ((dt.date(2023, 12, 1), dt.date(2024, 1, 3)), (dt.date(2024, 1, 20), dt.date(2024, 2, 10)), (dt.date(2024, 2, 2), dt.date(2024, 2, 2)),
                   (dt.date(2024, 3, 20), dt.date(2025, 1, 1)), (dt.date(2025, 1, 1), dt.date(2025, 2, 1))):
        a, z = F.lit(lo), F.lit(hi)
        want = dense.where(F.col("date").between(a, z))
        part = clip(intervals, ["flow", "other"], a, z)
        assert sorted(map(tuple, densify(part, ["e"], "date", ["flow", "other"], ["bal"]).collect())) == sorted(map(tuple, want.collect()))
        assert part.agg(F.sum(F.col("bal") * days_in())).first()[0] == want.agg(F.sum("bal")).first()[0]
        last = want.groupBy("e").agg(F.sum("flow").alias("flow"), F.sum("other").alias("other"), F.max_by("bal", "date").alias("bal"))
        assert sorted(map(tuple, balances_in(intervals, "e", ["flow", "other"], "bal", a, z).collect())) == sorted(map(tuple, last.collect()))


def test_reading_balances_builds_no_day_rows(spark):
    import contextlib
    import io
    intervals = running_intervals(_random_days(spark), ["e"], "date", ["flow", "other"], {"bal": F.col("flow")})
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        balances_in(intervals, "e", ["flow", "other"], "bal", F.lit(dt.date(2024, 1, 5)), F.lit(dt.date(2024, 3, 1))).explain()
    assert "sequence" not in out.getvalue()


def test_intervals_of_nothing(spark):
    empty = _random_days(spark).where("false")
    assert running_intervals(empty, ["e"], "date", ["flow"], {"bal": F.col("flow")}).count() == 0

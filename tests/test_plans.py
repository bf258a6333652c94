"""Structural checks on the physical plans of every registered query (sf0.001)."""
import contextlib
import io

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cross_joins_or_python_udfs(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"


def test_asof_join_keys_include_month_bucket(spark):
    from ledgerflow.plans.pipeline import TradingModel
    plan = _plan(TradingModel.from_driver(spark, SF).chosen_rates)  # the as-of itself, not its written stage
    join_lines = [ln for ln in plan.splitlines() if "Join" in ln and "__asof_bucket" in ln]
    assert join_lines, plan

"""Physical-plan checks: no Python on the data path, no Cartesian products,
column pruning at the scans, two exchanges in the weather chain."""

import re

import pytest

from aerowx.plans import preprocess as PP
from aerowx.sources import fixtures as FX
from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def parts(spark):
    f, w, s = FX.flights(spark, SF_SMALL), FX.weather(spark, SF_SMALL), FX.stations(spark, SF_SMALL)
    return f, w, s


@pytest.mark.parametrize("method", ["list", "frame"])
def test_no_python_no_cartesian(parts, method):
    plan = _plan(PP.ml_table(*parts, method=method))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in plan, bad


def test_scans_are_pruned(parts, spark):
    plan = PP.ml_table(*parts)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas, plan[:2000]
    for s in schemas:
        assert "o_orderstatus" not in s and "o_orderpriority" not in s and "props" not in s


def test_weather_chain_pre_reduces_then_shuffles_once_by_day(parts):
    """Two hash exchanges on the reading side: the hash aggregate that drops
    copies (partial under it, without a sort), and the (airport, date)
    exchange that the minute, daily-mean and first-of-hour windows reuse,
    with one sort."""
    f, w, s = parts
    obs = PP.prepare(f, w, s).observations
    plan = _plan(obs)
    top = plan.split("BroadcastHashJoin")[0]     # above the airport-set join
    assert top.count("Exchange hashpartitioning") == 2, top
    assert top.count("HashAggregate") == 2 and "SortAggregate" not in top, top
    assert len(re.findall(r"\bSort \[", top)) == 1, top
    assert top.index("Sort [") < top.index("Exchange hashpartitioning"), top  # printed from the top down
    assert re.search(r"Exchange hashpartitioning\(AIRPORT_ID#\d+, Date#\d+, \d+\), REPARTITION", top), top

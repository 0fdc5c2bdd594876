"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from suite import load
from tests.conftest import SMALL
from tools.check import compare, connect

QUERIES = entry_module.queries()
ORACLES = entry_module.oracle_sql()
APART = set(QUERIES) - set(load().QUERIES)  # the training-data operators, where they are installed


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_twin(spark, duck, name):
    built = []

    def run(session, folder):
        built.append(QUERIES[name](session, folder))
        return built[0]

    ok, note, _ = compare(spark, duck, SMALL, name, run, ORACLES.get(name))
    plan = built[0]._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python
    if name not in APART:
        assert "Python" not in plan and "InArrow" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in ORACLES:
        assert ok, note


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 3

"""Every registered query against its SQL, and the driver contract."""

import itertools
import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks.compare import difference, duck
from checks.oracles import SQL
from checks.queries import QUERIES
from support import plan_of


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, sf, name, capsys):
    df = QUERIES[name](spark, sf)
    assert difference(con, name, df) is None
    assert not re.search("CartesianProduct|NestedLoopJoin|PythonUDF|ArrowEval|MapInPandas", plan_of(df, capsys))


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_months_are_never_broadcast(spark, sf):
    """No broadcast side holds the month generator, whose rows Spark's size estimate does not see."""
    for name in ("spell_snapshot_join", "membership_report", "membership_with_residence", "best_spell_per_month"):
        tree = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        depths = [(len(re.match(r"[ :+\-*|]*", line)[0]), line) for line in tree.splitlines()]
        for i, (depth, line) in enumerate(depths):
            if "BroadcastExchange" in line:
                assert any("explode(sequence(" in text for _, text in depths), name
                below = itertools.takewhile(lambda x: x[0] > depth, depths[i + 1 :])
                assert not any("Generate explode(sequence(" in text for _, text in below), name


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "sum_amount_usd" in df.columns


def test_no_query_limits_its_input():
    text = (Path(__file__).parents[1] / "checks" / "queries.py").read_text()
    assert not re.search(r"\.limit\(|\.sample\(|\.head\(", text)


def test_entry_without_optional_libraries():
    """Without a library of the optional package, the queries of the core are all there."""
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[1], capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(QUERIES)), "True"]

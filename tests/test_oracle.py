"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

from feedlens.plans import CHECK, ORACLE, QUERIES
from feedlens.plans.compare import compare, type_problems
from tests.conftest import SMOKE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMOKE)
    srows = df.collect()
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    problems = compare(df.columns, srows, dcols, cur.fetchall())
    problems += type_problems(df.schema, duck.execute("DESCRIBE " + ORACLE[name]).fetchall())
    assert not problems, problems
    assert_scalable_plan(df)


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def assert_scalable_plan(df):
    """No pair-producing join and no row-at-a-time Python UDF in the executed plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, bad


@pytest.mark.parametrize("name", sorted(n for n, c in CHECK.items() if c == "R"))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SMOKE)
    assert df.count() > 0
    assert_scalable_plan(df)


def test_every_query_has_a_check():
    assert set(CHECK) == set(QUERIES)
    assert set(ORACLE) <= set(QUERIES)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())

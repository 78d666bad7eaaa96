"""Every registered query with SQL matches DuckDB on sf0.001 (the driver
checks sf0.01 the same way)."""

import pytest

from widetab.plans.registry import load_all

from conftest import SMALL, rows_equal

REG = load_all()
WITH_SQL = sorted(n for n, q in REG.items() if q.sql)


# Physical operators that would not survive scale (or leave the JVM).
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_oracle(spark, duck, name):
    q = REG[name]
    df = q.build(spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], plan
    rows = df.collect()
    res = duck.execute(q.sql)
    rows_equal(rows, df.columns, res.fetchall(), [d[0] for d in res.description])


def test_every_query_names_operators():
    for name, q in REG.items():
        assert q.operators, name


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert set(E.oracle_sql()) <= set(E.queries())

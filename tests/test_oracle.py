"""Every query with SQL agrees with it exactly; the others run and give rows."""

import pytest

from tabkit.queries import QUERIES

from oracle import connect, difference

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_agrees_with_sql(spark, con, name):
    query = QUERIES[name]
    df = query.build(spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in plan
    assert difference(df, con, query.sql) is None


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_gives_rows(spark, name):
    assert QUERIES[name].build(spark, FOLDER).count() > 0


def test_a_difference_is_noticed(spark, con):
    query = QUERIES["value_counts"]
    df = query.build(spark, FOLDER)
    for wrong in ("rows + 1 AS rows", "CAST(rows AS DOUBLE) AS rows", "rows AS number"):
        assert difference(df, con, f"SELECT SOURCE, {wrong} FROM ({query.sql})") is not None
    assert difference(df, con, query.sql + " LIMIT 2") is not None

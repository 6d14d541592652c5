"""Every registered query against its SQL, and what its plan must not contain."""

from __future__ import annotations

import pytest
from conftest import SF
from oracle import duck_rows, duck_types, spark_rows, spark_types

from estrato.plans.registered import all_queries

QUERIES = all_queries()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, name):
    query, sql = QUERIES[name]
    df = query(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in plan
    columns, rows = spark_rows(df)
    assert rows, "a query over the test tables returns rows"
    assert sql is not None
    assert (columns, rows) == duck_rows(SF, sql)
    assert spark_types(df) == duck_types(SF, sql)

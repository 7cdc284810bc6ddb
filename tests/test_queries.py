"""Every registered query against its SQL counterpart, and the shape of its plan."""

import math

import duckdb
import pytest

from tallyhouse.workload import REGISTRY
from tests.conftest import SF_DIR

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_matches_sql(name, spark, duck):
    query = REGISTRY[name]
    df = query.run(spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    result = duck.execute(query.oracle())
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in result.fetchall())
    assert got == want
    assert got, "a query without rows proves nothing"

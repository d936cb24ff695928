"""Every query of the marketing model against its SQL counterpart, and the shape of every plan."""

import pytest

import checks
from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import differences, duck

QUERIES, SQLS = checks.QUERIES, checks.ORACLES


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "PythonUDF", "ArrowEvalPython", "BatchEvalPython",
                "MapInPandas"):
        assert bad not in plan, f"{bad} in the plan of {name}"
    if name in SQLS:
        assert differences(df, con, SQLS[name]) == []
    else:
        assert df.count() > 0


def test_all_of_them_are_registered():
    assert set(QUERIES) <= set(queries()) and set(SQLS) <= set(oracle_sql()) <= set(queries())


def test_every_sql_has_a_query():
    assert set(SQLS) <= set(QUERIES)
    assert set(QUERIES) - set(SQLS) == {"file_health", "dataset_report"}


def test_entry(spark):
    rows = {r["qualidade_lead"]: r["n_contacts"] for r in entry(spark).collect()}
    assert rows and all(n > 0 for n in rows.values())

"""Every registered query against its SQL; the others run and give rows."""

import re

import compare as compare_module
import pytest

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()
# several fits each; covered by their own tests
SLOW = {"m2_linear_svc", "m4_random_forest", "m5_benchmark", "m6_tune"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(name, spark, duck, folder):
    assert compare_module.compare(QUERIES[name](spark, folder), duck, SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - SLOW))
def test_gives_rows(name, spark, folder):
    assert len(QUERIES[name](spark, folder).take(1)) == 1


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(n for n in SQL if n[0] in "acept"))
def test_plan_stays_in_the_engine(name, spark, folder):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"PythonUDF|BatchEvalPython|ArrowEvalPython|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns[0] == "product" and frame.count() > 0

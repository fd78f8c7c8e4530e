"""Every query against its SQL, and the shape of every plan."""

import pytest

import compare
from threadlens.checks import ORACLES, QUERIES

MODELS = {
    "dt_reg", "gbt_reg", "rf_gini", "rf_entropy", "top_importances", "save_load_predict",
    "trained_sentiment", "embedded_sentiment",
}


@pytest.fixture(scope="module")
def duck(folder):
    return compare.connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, folder, name):
    result, _ = compare.compare(spark, duck, folder, name)
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS))
def test_plan_has_no_cross_join_and_no_python(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in plan, node


def test_filters_and_columns_reach_the_reader(spark, folder):
    plan = QUERIES["stratified_sample"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan" in line]
    assert scans and all("In(event_type" in line for line in scans)
    assert all("props" not in line and "user_id" not in line for line in scans)

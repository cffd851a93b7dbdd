"""Every catalogue key against its DuckDB oracle, plus plan-shape assertions."""

import pytest

from conftest import SMALL_SF
from ledgerlens.plans.catalog import KEPT, ORACLE, QUERIES
from oracle_harness import compare, duck

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SMALL_SF)


def test_every_key_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) == 114


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    res = compare(spark, key, SMALL_SF, con)
    assert res["ok"], res


FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "PythonUDF")


@pytest.mark.parametrize("key", sorted(set(KEYS) - set(KEPT)))  # those read what streams have stored
def test_plan_has_no_python_udf_or_cartesian(spark, key):
    plan = QUERIES[key](spark, SMALL_SF)._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan], plan


@pytest.mark.parametrize("key", ["clean_runs", "runner_pickup_minutes", "delivery_report",
                                 "web_visits_by_month", "campaign_summary"])
def test_keys_do_not_depend_on_the_session_time_zone(spark, con, key):
    # The data has naive times inside a daylight-saving gap of this zone.
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        res = compare(spark, key, SMALL_SF, con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert res["ok"], res

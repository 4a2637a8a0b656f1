"""Every registered query against its SQL on a second engine, and what its plan may not contain."""

import os

import pytest

import __spark_entry__ as entry
from helpers import plan_of
from verification.compare import arrow_types, oracle_connection, oracle_rows, spark_rows
from verification.oracle import oracles
from verification.registry import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
KEYS = sorted(REGISTRY)


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert KEYS == sorted(oracles())
    assert set(KEYS) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_agrees_with_sql(spark, oracle, key):
    df, sql = entry.queries()[key](spark, SF_DIR), entry.oracle_sql()[key]
    assert spark_rows(df) == oracle_rows(oracle, sql)
    assert arrow_types(df, oracle, sql) == []
    plan = plan_of(df)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython",
                     "ArrowEvalPython", "MapInPandas"):
        assert unwanted not in plan


def test_entry_gives_the_report(spark):
    assert entry.entry(spark).columns == ["product_name", "year", "aliased_month", "total_sales",
                                          "MoM_growth", "MoM_pct_growth"]


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("key", ["silver_transactions", "silver_clickstream", "silver_users"])
def test_results_do_not_depend_on_the_session_zone(spark, conf, oracle, key, zone):
    conf("spark.sql.session.timeZone", zone)
    assert spark_rows(entry.queries()[key](spark, SF_DIR)) == oracle_rows(
        oracle, entry.oracle_sql()[key])

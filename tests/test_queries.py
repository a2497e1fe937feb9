"""Every registered query against its SQL twin on the smallest tables, and checks of the plans."""

import os

import pytest

import check_oracle
from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    return check_oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, db, name):
    problems = check_oracle.compare(spark, db, SF_DIR, name, queries()[name], oracle_sql().get(name))
    assert [p for p in problems if p != "empty result"] == []


def test_entry(spark):
    assert entry(spark).columns == ["order_day", "city", "total_revenue", "total_orders", "total_items_sold",
                                    "avg_order_value", "unique_customers"]


BATCH = ["daily_revenue", "customer_summary", "discount_impact", "region_rollup", "fact_orders", "upsert_columns",
         "cdc_apply", "changed_between_versions", "federated_join", "monthly_retention", "delete_users"]


@pytest.mark.parametrize("name", BATCH)
def test_plan_has_no_cross_join_and_no_python(spark, plan, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if every table were large
    try:
        text = plan(queries()[name](spark, SF_DIR))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for word in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in text

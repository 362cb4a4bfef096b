"""Reports are shuffled once by order before they meet it, and once by record to look back at what a change can differ in."""

import re
from pathlib import Path

import pytest

from shopfloor.plans import queries
from shopfloor.sources import fixtures

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


def plan_of(spark, make) -> str:
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_reports_are_dealt_once_by_order(spark):
    plan = plan_of(spark, lambda: fixtures.log(spark, str(DATA)))
    assert len(re.findall(r"hashpartitioning\(l_orderkey", plan)) == 1


def test_rows_are_not_sorted_with_whole_images(spark):
    changes = fixtures.log(spark, str(DATA))
    plan = plan_of(spark, lambda: fixtures.envelopes(changes))
    below = plan[plan.index("Window [lag(") :]
    assert "date_format" not in below.split("\n", 1)[1]


@pytest.mark.parametrize("name", ["alert_totals", "digest_messages", "digest_rate_limit", "dim_achievement", "escalation_history", "lag_alerts", "latest_alerts", "live_wide", "minute_merge", "minute_output", "minute_salted", "next_levels", "order_achievement", "order_running_blocks", "order_running_qty", "signed_deltas", "total_check"])
def test_no_query_broadcasts_a_growing_dimension(spark, name):
    """With a limit of a few KB, as if the tables were larger."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32k")
    try:
        plan = queries.QUERIES[name](spark, str(DATA))._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    sent = [line for line in plan.splitlines() if "BroadcastHashJoin" in line or "BroadcastNestedLoopJoin" in line]
    assert not [line for line in sent if any(key in line for key in ("partid", "createdbyid", "workcenterid", "custkey"))]

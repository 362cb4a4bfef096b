"""Growing tables are joined at their real size, not broadcast by a guess that compression and explosion make too small."""

from pathlib import Path

import pytest

from shopfloor.plans import queries
from shopfloor.sources import fixtures

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


def test_dimensions_are_not_guessed_smaller_than_they_are(spark):
    for name, dim in fixtures.dims(spark, str(DATA)).items():
        guess = int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        assert guess >= 8 * len(dim.columns) * dim.count(), name


def test_customers_and_parts_meet_orders_without_a_broadcast(spark):
    plan = fixtures.log(spark, str(DATA))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") >= 2


@pytest.mark.parametrize("name", ["current_alerts", "wide_roundtrip"])
def test_queries_broadcast_no_growing_dimension(spark, name):
    """With a limit of a few KB, as if the tables were larger, only the fixed list of databases and the nations are sent."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32k")
    try:
        plan = queries.QUERIES[name](spark, str(DATA))._jdf.queryExecution().sparkPlan()
        sent = [line for line in plan.toString().splitlines() if "BroadcastHashJoin" in line]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert not [line for line in sent if any(key in line for key in ("partid", "createdbyid", "workcenterid", "custkey"))]

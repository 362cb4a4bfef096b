"""What JSON is parsed, is parsed once a row, whatever is filtered afterwards."""

from pathlib import Path

import pytest

from shopfloor.plans import queries

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.mark.parametrize("name", ["order_changelog", "current_orders", "wide_roundtrip"])
def test_filters_do_not_parse_again(spark, name):
    plan = queries.QUERIES[name](spark, str(DATA))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1

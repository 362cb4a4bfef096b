"""A large log goes through its joins in slices, with the same rows, and leaves no shuffle files of steps that are over."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shopfloor.operators.versions import RECORD
from shopfloor.plans import queries
from shopfloor.sources import shared

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.mark.parametrize("name", ["live_wide", "minute_output", "minute_salted", "minute_merge", "total_check", "quality_profile"])
def test_slices_give_the_same_rows(spark, monkeypatch, name):
    whole = queries.QUERIES[name](spark, DATA)
    monkeypatch.setattr(queries, "LARGE", 0)
    sliced = queries.QUERIES[name](spark, DATA)
    assert sliced.dtypes == whole.dtypes
    assert sorted(sliced.collect(), key=repr) == sorted(whole.collect(), key=repr)


def test_a_large_log_is_joined_before_its_query_reads_it(spark, monkeypatch):
    """What is left for the query reads a table, so its disk holds the shuffles of no join."""
    monkeypatch.setattr(queries, "LARGE", 0)
    plan = queries.QUERIES["minute_output"](spark, DATA)._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_slices_hold_every_record_once(spark):
    rows = spark.range(100).select(*[F.lit("x").alias(c) for c in RECORD[:2]], (F.col("id") % 40).cast("string").alias("record_id"))
    sizes = []

    def make(own):
        sizes.append(own.count())
        return own.groupBy(*RECORD).count()

    found = shared.in_slices(rows, RECORD, make, "some", 4)
    assert len(sizes) == 4 and sum(sizes) == 100 and max(sizes) < 100
    assert found.count() == 40 and found.agg(F.sum("count")).first()[0] == 100

"""What streams leave on disk: no shuffle files of writes that are over, no input that was taken, packed lines."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shopfloor.plans import queries
from shopfloor.sources import fixtures, shared
from shopfloor.streaming import sinks

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.mark.parametrize("lines", [False, True])
def test_inputs_are_made_once_and_go_when_taken(spark, lines):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    value = F.lit('{"op":"c","after":{"record_id":"1"},"seq":1}').alias("value")
    rows = spark.range(9).select("id", value).mapInArrow(count, "id long, value string")
    seen, settings = [], []

    def make(streams, path):
        def batch(df, batch_id):
            settings.append(df.sparkSession.conf.get(shared.CLEAN))
            files = [f for f in Path(path.removeprefix("file:")).glob("in/rows/**/part-*")]
            assert not lines or all(f.name.endswith(".txt.gz") for f in files)
            seen.append((df.count(), {f.parent.name for f in files}))

        return streams["rows"], batch

    before = spark.conf.get(shared.CLEAN)
    path = queries.streamed(queries.Inputs(spark, DATA), make, lines=lines, rows=(rows, F.col("id") % 2 + 1))
    parts = [{f"part_no={k}" for k in range(first, 4)} for first in (1, 2, 3)]
    assert seen == list(zip((5, 4, 0), parts, strict=True)), seen
    assert made.value == 9 and settings == ["true"] * 3 and spark.conf.get(shared.CLEAN) == before
    assert not list(Path(path.removeprefix("file:")).glob("in/rows/part_no=*"))


def test_a_log_is_packed(spark, tmp_path):
    message = spark.createDataFrame([("1", 1, 1, "k", "v" * 10_000)], "id string, version long, seq long, key string, value string").coalesce(1)
    sinks.log_batch(str(tmp_path / "log"), lambda df: df)(message, 0)
    (file,) = (tmp_path / "log").glob("part-*")
    assert file.stat().st_size < 1000 and spark.read.schema(sinks.LOG).json(str(tmp_path / "log")).first()["value"] == "v" * 10_000


def test_scratch_and_shuffles_of_a_table_go(spark):
    table = shared.stored(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "some")
    assert table.count() == 7 and table.agg(F.sum("count")).first()[0] == 100


def test_minute_batches_keep_no_wide_rows(spark, tmp_path):
    log, dims = fixtures.log(spark, DATA), fixtures.dims(spark, DATA)
    sinks.minute_deltas_batch(dims, str(tmp_path))(log.where("version = 1"), 0)
    assert not (tmp_path / "wide").exists()
    assert "username" not in spark.read.parquet(str(tmp_path / "state")).columns

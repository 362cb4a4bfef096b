"""Drill-down of differences, joins of rows without keys, late minutes, a log that is sent twice, rolling limits, metrics."""

import random
from collections import Counter
from decimal import Decimal

from pyspark.sql import Row
from pyspark.sql import functions as F

from shopfloor.operators import reconcile, wide
from shopfloor.sources import fixtures
from shopfloor.streaming import metrics, sinks, timers
from tests.test_timers import Handle

SF = "/root/testdata/sf0.001"
LEVELS, RECORD = ["site", "line"], ["id"]
SCHEMA = "site string, line string, id string, qty decimal(38,4)"


def side(spark, *rows):
    return spark.createDataFrame([(s, line, i, Decimal(q)) for s, line, i, q in rows], SCHEMA)


def found(df):
    return sorted(((r.site, r.line, r.id, int(r.baseline_qty), r.baseline_cnt, int(r.result_qty), r.result_cnt) for r in df.collect()), key=repr)


def test_records_behind_differences(spark):
    """Differences that cancel out, missing keys, repeated rows, and records that change their group are found."""
    base = side(spark, ("a", "1", "x", 5), ("a", "1", "y", 5), ("a", None, "z", 1), ("a", "2", "s", 3), ("a", "2", "s", 3), ("b", "1", "m", 4), ("b", "3", "e", 9))
    result = side(spark, ("a", "1", "x", 6), ("a", "1", "y", 4), ("a", None, "z", 2), ("a", "2", "s", 6), ("b", "2", "m", 4), ("b", "3", "e", 9))
    assert found(reconcile.differing_records(base, result, LEVELS, RECORD)) == sorted(
        [("a", "1", "x", 5, 1, 6, 1), ("a", "1", "y", 5, 1, 4, 1), ("a", None, "z", 1, 1, 2, 1), ("a", "2", "s", 6, 2, 6, 1), ("b", "1", "m", 4, 1, 0, 0), ("b", "2", "m", 0, 0, 4, 1)], key=repr
    )
    tree = {(r.level, r.site, r.line): (r.groups, r.within_tolerance) for r in reconcile.difference_tree(base, result, LEVELS, RECORD).collect()}
    assert tree[(2, "a", "1")] == (1, True) and tree[(1, "a", None)] == (3, False) and tree[(1, "b", None)] == (2, True) and tree[(0, None, None)][0] == 5
    assert (2, "b", "3") not in tree


def test_equal_sides_and_empty_ones_have_no_differences(spark):
    base = side(spark, ("a", "1", "x", 5), ("a", "1", "y", 5))
    assert reconcile.differing_records(base, base.orderBy(F.desc("id")), LEVELS, RECORD).count() == 0
    none = base.limit(0)
    assert reconcile.difference_tree(none, none, LEVELS, RECORD).count() == 0
    assert len(found(reconcile.differing_records(base, none, LEVELS, RECORD))) == 2


def test_rows_without_a_key_are_dealt_over_parts(spark):
    """They meet nothing, not even a dimension row without a key, and a shuffle spreads them."""
    rows = spark.range(2000).select(F.lit("d").alias("db_name"), F.when(F.col("id") < 4, F.col("id")).alias("k"), F.col("id").cast("string").alias("record_id"), F.lit(1).alias("version"), F.lit(1).alias("seq"))
    dim = spark.createDataFrame([("d", 0, "zero"), ("d", 1, "one"), ("d", None, "none")], "db_name string, k bigint, name string")
    kept = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = wide.met(rows, dim, "k").withColumn("part", F.spark_partition_id()).collect()
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    assert len(got) == 2000 and Counter(r.name for r in got) == {"zero": 1, "one": 1, None: 1998}
    assert max(Counter(r.part for r in got).values()) < 1000


def limited(rows, most, window):
    p = timers.RollingLimit(most, window, event=True, ttl_ms=None)
    p.init(Handle())
    p.load()
    out = [r.sent for r in p._until(("all",), sorted(rows, key=p.order), 10**9)]
    p.save()
    return out, p.times.get() if p.times.exists() else []


def test_rolling_limit_equals_a_replay():
    rng = random.Random(3)
    for _ in range(30):
        most, window = rng.randint(1, 4), rng.randint(1, 30)
        rows = [Row(company=rng.choice(["a", None]), alert_type=rng.choice("xy"), event_ms=rng.randint(0, 120)) for _ in range(rng.randint(0, 60))]
        accepted, want = [], []
        for at in sorted(r.event_ms for r in rows):
            want.append(sum(at - t <= window for t in accepted) < most)
            if want[-1]:
                accepted.append(at)
        got, held = limited(rows, most, window)
        assert got == want and len(held) <= most


def test_late_minutes_and_those_in_time_are_all(spark, tmp_path):
    """Also where batches run again; the first batch has no late rows, and the clock never goes back."""
    log, dims = fixtures.log(spark, SF), fixtures.dims(spark, SF)
    path = str(tmp_path)
    batch = sinks.minute_deltas_batch(dims, path, (0, 86400))
    old = F.col("event_time") < F.lit("1998-01-01").cast("timestamp_ntz")
    for k, rows in ((0, log.where("version = 1")), (1, log.where(old & (F.col("version") == 2))), (1, log.where(old & (F.col("version") == 2))), (2, log.where((F.col("version") > 2) | ~old & (F.col("version") == 2)))):
        batch(rows, k)
    late = {r.batch_id: (r.late, r.in_time) for r in sinks.late_rows(spark, path).collect()}
    assert late[0][0] == 0 and late[1][0] > 0 and late[1][1] == 0
    seen = [sinks.clock_before(spark, f"{path}/clock", k) for k in (1, 2, 3)]
    assert seen[0] == seen[1] <= seen[2] and sinks.clock_before(spark, f"{path}/clock", 0) is None
    apart, live = sinks.late_minutes(spark, path), wide.live_of(log, dims)
    assert apart.agg(F.sum("output_quantity")).first()[0] == live.agg(F.sum("lotquantity")).first()[0]
    assert apart.where("late_flag").count() > 0 and apart.where("not late_flag").count() > 0


def test_a_log_that_has_messages_again_is_read_once(spark, tmp_path):
    """Within a batch of the reader and across them; other versions, and messages without a version, stay."""
    path, rows = str(tmp_path / "log"), spark.createDataFrame([("a", 1, 1, "k", "v"), ("a", 2, 1, "k", "w"), ("b", None, None, None, None)], "id string, version long, seq long, key string, value string")
    send = sinks.log_batch(path, lambda df: df)
    send(rows, 0)
    send(rows, 0)
    for k in range(2):
        sinks.start(sinks.read_log(spark, path), sinks.rows_batch(str(tmp_path), "once"), str(tmp_path / "read")).awaitTermination()
        assert sorted(((r.id, r.version) for r in sinks.written(spark, str(tmp_path / "once")).collect()), key=repr) == [("a", 1), ("a", 2), ("b", None)]
        send(rows, 1)
    spark.createDataFrame([("a", 3, 1, "k", "x")], rows.schema).transform(lambda df: send(df, 2) or df)
    sinks.start(sinks.read_log(spark, path), sinks.rows_batch(str(tmp_path), "once"), str(tmp_path / "read")).awaitTermination()
    assert sinks.written(spark, str(tmp_path / "once")).count() == 4


def test_figures_of_a_batch_that_ran_again_count_once(spark, tmp_path):
    path = str(tmp_path / "m")
    rows = [("q", 0, "quality.changes", 5.0, 1), ("q", 0, "quality.changes", 7.0, 2), ("q", 1, "quality.changes", 1.0, 3), ("q", 1, "flush_ms", 9.0, 3)]
    for r in rows:
        spark.createDataFrame([r], metrics.METRIC).write.mode("append").parquet(path)
    assert [(r.metric, r.value) for r in metrics.totals(metrics.read(spark, path)).collect()] == [("quality.changes", 8)]


def test_listener_gathers_rows_flushes_and_counters(spark, tmp_path):
    log = fixtures.log(spark, SF)
    log.write.parquet(str(tmp_path / "in"))
    seen = metrics.Metrics(spark, str(tmp_path / "metrics"))
    spark.streams.addListener(seen)
    try:
        stream = spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))
        running = sinks.start(metrics.observed_changes(wide.enrich(stream, fixtures.dims(spark, SF))), sinks.rows_batch(str(tmp_path), "wide"), str(tmp_path / "checkpoint"))
        running.awaitTermination()
        assert seen.settled(running)
    finally:
        spark.streams.removeListener(seen)
    got = {r.metric: r.value for r in metrics.read(spark, str(tmp_path / "metrics")).where("batch = 0").collect()}
    assert got["quality.changes"] == got["rows"] == log.count() and got["flush_ms"] > 0 and "state_bytes" in got
    assert got["quality.deleted"] == log.where("op = 'd'").count() and got["dim_miss.MANUAL_order_miss"] == 0

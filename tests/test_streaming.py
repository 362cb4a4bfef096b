"""Streams against batch: split and shuffled input, replays, timers."""

import time
from decimal import Decimal

from pyspark.sql import functions as F

from shopfloor.operators import wide
from shopfloor.operators.orders import order_achievement
from shopfloor.sources import fixtures
from shopfloor.streaming import sinks, timers

SF = "/root/testdata/sf0.001"


def test_replayed_batch_replaces_itself(spark, tmp_path):
    df = spark.range(3)
    for _ in range(2):
        sinks.idempotent_append(df, str(tmp_path / "t"), 0)
    sinks.idempotent_append(df, str(tmp_path / "t"), 1)
    assert sinks.written(spark, str(tmp_path / "t")).count() == 6


def test_batches_run_again_give_the_same_minutes(spark, tmp_path):
    log = fixtures.log(spark, SF)
    batch = sinks.minute_deltas_batch(fixtures.dims(spark, SF), str(tmp_path))
    batch(log.where("version = 1"), 0)
    batch(log.where("version > 1"), 1)
    first = sorted(sinks.minutes(spark, str(tmp_path)).collect())
    batch(log.where("version > 1"), 1)
    assert sorted(sinks.minutes(spark, str(tmp_path)).collect()) == first
    live = wide.live_wide(wide.enrich(log, fixtures.dims(spark, SF)))
    assert sum(r.output_quantity for r in first) == live.agg(F.sum("lotquantity")).first()[0]


def test_dimensions_are_loaded_again_and_kept_on_failure():
    now, answers = [0.0], [{"users": 1, "orders": 1}, {"users": 2, "orders": 2}, ValueError()]

    def load():
        got = answers.pop(0)
        if isinstance(got, Exception):
            raise got
        return got

    get = sinks.refreshed(load, 300, lambda: now[0])
    assert get() == {"users": 1, "orders": 1}
    now[0] = 300
    assert get() == {"users": 2, "orders": 1}
    now[0] = 600
    assert get() == {"users": 2, "orders": 1}


def test_wide_table_by_shift_day(spark, tmp_path):
    live = wide.live_wide(wide.enrich(fixtures.log(spark, SF), fixtures.dims(spark, SF)))
    for _ in range(2):  # a replay replaces itself
        found = sinks.write_wide(live.limit(50), str(tmp_path / "w"), 0)
        assert found["rows"] == 50 and found["flush_ms"] > 0
    back = spark.read.parquet(str(tmp_path / "w"))
    assert back.count() == 50 and back.where("linecode is null").count() == 0


def test_windowed_minutes_equal_the_batch(spark, tmp_path):
    rows = spark.read.parquet(f"{SF}/events.parquet").select(F.col("ts").cast("timestamp").alias("event_time"), F.col("event_type").alias("company"), F.lit("W").alias("workshop"), F.col("user_id").cast("string").alias("linecode"), F.lit("P").alias("partcode"), F.col("value").cast("decimal(38,4)").alias("qty_delta"), F.lit(1).alias("cnt_delta"))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = sinks.windowed_minutes(stream).writeStream.format("memory").queryName("windowed").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    want = rows.groupBy(F.date_trunc("minute", "event_time").alias("ts_minute"), "company", "linecode").agg(F.sum("qty_delta").alias("q"))
    assert sorted(spark.table("windowed").select("ts_minute", "company", "linecode", "output_quantity").collect()) == sorted(want.collect())


def test_idle_timer_fires_without_input(spark, tmp_path):
    spark.createDataFrame([("zh", "L1")], "company string, linecode string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("company string, linecode string").parquet(str(tmp_path / "in"))
    out = timers.idle_lines(stream, timers.IdleLine(idle_ms=1500, escalate_ms=1500))
    q = out.writeStream.format("memory").queryName("idle").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    try:
        until = time.time() + 60
        while time.time() < until and spark.table("idle").count() < 3:
            time.sleep(1)
        assert [r.level for r in spark.table("idle").orderBy("changed_ms").collect()][:3] == ["P3", "P2", "P1"]
    finally:
        q.stop()


ORDER_ROWS = "company string, datasource string, productionorder string, record_id string, version long, qty decimal(38,4), is_deleted boolean, event_ms long, order_quantity long, created_ms long, due_ms long"


def test_order_alerts_and_snapshots(spark, tmp_path):
    """A lags, and catches up; B is reported over its quantity, taken back by a later version, and rises to P1."""
    one = lambda order, record, version, qty, at, gone=False: ("zh", "OLD_MES", order, record, version, Decimal(qty), gone, at, 100, 1, 1001)
    batches = [
        [one("A", "1", 1, 10, 500), one("B", "1", 1, 90, 10), one("B", "2", 1, 30, 20), one("C", "1", 1, 50, 10)],
        [one("A", "2", 1, 60, 600), one("B", "2", 2, 5, 30), one("B", "2", 1, 30, 20), one("C", "1", 2, 50, 20, True)],
    ]
    source = str(tmp_path / "in")
    spark.createDataFrame(batches[0], ORDER_ROWS).coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(spark.createDataFrame([], ORDER_ROWS).schema).parquet(source)
    run = lambda df, name: df.writeStream.format("memory").queryName(name).outputMode("update").option("checkpointLocation", str(tmp_path / name)).trigger(processingTime="1 second").start()
    running = [run(timers.order_alerts(stream, timers.OrderAlerts(escalate_ms=4000)), "order_alerts"), run(timers.order_snapshots(stream, timers.OrderSnapshots(every_ms=1000)), "order_snapshots")]
    alerts = lambda: [(r.productionorder, r.alert_type, r.level) for r in spark.table("order_alerts").orderBy("changed_ms", "productionorder").collect()]
    try:
        until = time.time() + 90
        while time.time() < until and len(alerts()) < 2:
            time.sleep(0.5)
        assert set(alerts()[:2]) == {("A", "LAG", "P3"), ("B", "OVER_REPORT", "P3")}
        spark.createDataFrame(batches[1], ORDER_ROWS).coalesce(1).write.mode("append").parquet(source)
        last = lambda: {r.productionorder: (float(r.report_quantity), float(r.achieve_rate)) for r in spark.table("order_snapshots").orderBy("version").collect()}
        while time.time() < until and (("A", "LAG", "NONE") not in alerts() or ("B", "OVER_REPORT", "P1") not in alerts() or last().get("C") != (0.0, 0.0)):
            time.sleep(0.5)
        assert [x[2] for x in alerts() if x[0] == "B"] == ["P3", "P2", "P1"] and alerts()[-1][0] in "AB" and ("A", "LAG", "NONE") in alerts()
        assert last() == {"A": (70.0, 0.7), "B": (95.0, 0.95), "C": (0.0, 0.0)}
        assert all(r.recover_ms > 0 for r in spark.table("order_alerts").where("level = 'NONE'").collect())
    finally:
        for q in running:
            q.stop()


def test_alert_sink_replaces_a_replay(spark, tmp_path):
    rows = spark.createDataFrame([("LAG:zh:o", 1000, 0), ("LAG:zh:p", 2000, 5000)], "alert_id string, alert_ms long, recover_ms long")
    for _ in range(2):
        sinks.alerts_batch(str(tmp_path / "a"))(rows, 3)
    got = {r.alert_id: r.recover_time for r in sinks.written(spark, str(tmp_path / "a")).collect()}
    assert len(got) == 2 and got["LAG:zh:o"] is None and got["LAG:zh:p"] is not None


def test_state_is_read_from_the_last_whole_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "COMPACT", 2)
    log, dims = fixtures.log(spark, SF), fixtures.dims(spark, SF)
    batch = sinks.minute_deltas_batch(dims, str(tmp_path))
    for k, rows in enumerate((log.where("version = 1"), log.where("version = 2"), log.where("version = 3"), log.where("version > 3"))):
        batch(rows, k)
    assert set(sinks.state_before(spark, str(tmp_path / "state"), 3).select("record_id").distinct().collect()) == set(log.where("version <= 3").select("record_id").distinct().collect())
    live = wide.live_of(log, dims)
    assert sum(r.output_quantity for r in sinks.minutes(spark, str(tmp_path)).collect()) == live.agg(F.sum("lotquantity")).first()[0]


def test_order_batches_equal_all_rows_at_once(spark, tmp_path, monkeypatch):
    """Over a whole state and after it, with a batch that runs again and records that move to another order."""
    monkeypatch.setattr(sinks, "COMPACT", 2)
    log, dims = fixtures.log(spark, SF), fixtures.dims(spark, SF)
    orders = dims["orders"].groupBy("db_name").agg(F.max("productionorderid").alias("_last"))
    moved = (F.col("version") == 3) & (F.col("record_id").cast("bigint") % 5 == 0)
    log = log.join(orders, "db_name").withColumn("productionorderid", F.when(moved, F.col("_last")).otherwise(F.col("productionorderid"))).drop("_last")
    now = F.lit("1996-06-01 00:00:00").cast("timestamp_ntz")
    batch = sinks.orders_batch(dims, str(tmp_path), now)
    for k, rows in ((0, "version = 1"), (1, "version = 2"), (1, "version = 2"), (2, "version = 3"), (3, "version > 3")):
        batch(log.where(rows), k)
    columns = ["company", "datasource", "productionorder", "report_quantity", "order_quantity", "last_report_time", "achieve_rate"]
    want = order_achievement(wide.live_of(log, dims), now, "order").where("productionorder is not null")
    got = sinks.achievements(spark, str(tmp_path))
    assert sorted(got.select(*columns).collect()) == sorted(want.select(*columns).collect())

"""Processors of keyed streams by a stand-in of Spark's state, and initial states and expiry in streams."""

import time
from decimal import Decimal

from pyspark.sql import Row

from shopfloor.schemas import columns
from shopfloor.streaming import sinks, timers


class Value:
    def __init__(self):
        self.at = None

    def exists(self):
        return self.at is not None

    def get(self):
        return self.at

    def update(self, value):
        self.at = value

    def clear(self):
        self.at = None


class Listed(Value):
    def appendList(self, rows):
        self.at = (self.at or []) + list(rows)

    def put(self, rows):
        self.at = list(rows)


class Mapped:
    def __init__(self):
        self.of = {}

    def exists(self):
        return bool(self.of)

    def containsKey(self, key):
        return key in self.of

    def getValue(self, key):
        return self.of[key]

    def updateValue(self, key, value):
        self.of[key] = value

    def iterator(self):
        return iter(self.of.items())

    def clear(self):
        self.of = {}


class Handle:
    def __init__(self):
        self.timers = set()

    def getValueState(self, *_, **__):
        return Value()

    def getListState(self, *_, **__):
        return Listed()

    def getMapState(self, *_, **__):
        return Mapped()

    def listTimers(self):
        return iter(sorted(self.timers))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


class Now:
    def __init__(self, at):
        self.at = at

    def getCurrentProcessingTimeInMs(self):
        return self.at

    getCurrentWatermarkInMs = getExpiryTimeInMs = getCurrentProcessingTimeInMs


def started(processor):
    processor.init(Handle())
    return processor


def until(processor, key, now):
    """What the timers up to now give, on either clock."""
    out = []
    while (due := min(processor.handle.timers, default=None)) is not None and due <= now:
        processor.handle.timers.discard(due)
        out += list(processor.handleExpiredTimer(key, Now(now if processor.event else due), Now(due)))
    return out


ORDER = ("zh", "OLD_MES", "A")


def report(record, version, qty, at, gone=False):
    return Row(record_id=record, version=version, qty=Decimal(qty), is_deleted=gone, event_ms=at, order_quantity=100, created_ms=1, due_ms=1001)


def test_each_kind_of_alert_has_its_own_deadline():
    """A lag that comes while an over-report stands at P1 rises to P1 itself, and no alert puts off the other's step."""
    p = started(timers.OrderAlerts(escalate_ms=100))
    got = list(p.handleInputRows(ORDER, [report("1", 1, 150, 900)], Now(10_000)))
    got += until(p, ORDER, 10_300)
    assert [(r.alert_type, r.level, r.changed_ms) for r in got] == [("OVER_REPORT", "P3", 10_000), ("OVER_REPORT", "P2", 10_100), ("OVER_REPORT", "P1", 10_200)]
    got = list(p.handleInputRows(ORDER, [report("1", 2, 5, 950)], Now(10_350))) + until(p, ORDER, 10_900)
    assert [(r.alert_type, r.level, r.changed_ms) for r in got] == [("LAG", "P3", 10_350), ("LAG", "P2", 10_450), ("LAG", "P1", 10_550)]
    assert not p.handle.timers
    p = started(timers.OrderAlerts(escalate_ms=100))
    got = list(p.handleInputRows(ORDER, [report("1", 1, 5, 900)], Now(0))) + list(p.handleInputRows(ORDER, [report("2", 1, 200, 910)], Now(60)))
    assert [(r.alert_type, r.level) for r in got] == [("LAG", "P3"), ("OVER_REPORT", "P3"), ("LAG", "NONE")]
    assert [(r.alert_type, r.level, r.changed_ms) for r in until(p, ORDER, 161)] == [("OVER_REPORT", "P2", 160)]


def test_rows_out_of_order_count_in_order_on_the_event_clock():
    rows = [report("1", 1, 10, 500), report("2", 1, 60, 600), report("3", 1, 40, 700), report("3", 2, 30, 900)]
    p = started(timers.OrderAlerts(escalate_ms=30, event=True, ttl_ms=None))
    assert not list(p.handleInputRows(ORDER, [rows[3], rows[1]], Now(0))) and not list(p.handleInputRows(ORDER, [rows[2], rows[0]], Now(0)))
    assert p.handle.timers == {500}
    got = until(p, ORDER, 610) + until(p, ORDER, 1000)
    assert [(r.alert_type, r.level, r.changed_ms) for r in got] == [("LAG", "P3", 500), ("LAG", "P2", 530), ("LAG", "P1", 560), ("LAG", "NONE", 600), ("OVER_REPORT", "P3", 700), ("OVER_REPORT", "P2", 730), ("OVER_REPORT", "P1", 760)]


def test_a_gap_of_just_the_threshold_and_a_step_at_recovery():
    p = started(timers.IdleLine(100, 50, None, event=True))
    list(p.handleInputRows(("zh", "L"), [Row(event_ms=t) for t in (1000, 1100, 1250)], Now(0)))
    got = [(r.level, r.changed_ms) for r in until(p, ("zh", "L"), 1300)]
    assert got == [("P3", 1100), ("NONE", 1100), ("P3", 1200), ("NONE", 1250)]


def test_state_on_the_event_clock_expires():
    p = started(timers.OrderSnapshots(10, event=True, ttl_ms=1000))
    list(p.handleInputRows(ORDER, [report("1", 1, 10, 100)], Now(0)))
    assert [(r.version, r.report_quantity) for r in until(p, ORDER, 500)] == [(110, 10)] and p.handle.timers == {1100}
    assert not until(p, ORDER, 1100) and not p.handle.timers and not p.order_state.exists() and not p.records.exists()


def test_snapshots_are_throttled():
    p = started(timers.OrderSnapshots(100))
    for at in (0, 50, 90):
        list(p.handleInputRows(ORDER, [report(str(at), 1, 10, at)], Now(at)))
    assert [(r.version, r.report_quantity) for r in until(p, ORDER, 1000)] == [(100, 30)]


HELD = columns(timers.Normalizer.HELD).fieldNames()


def minute(version, qty, live=True, at=7):
    return Row(**dict(zip(HELD, (version, version, live, at, "zh", "W", "L", "P", "Line", Decimal(qty)), strict=True)))


def test_normalizer_ignores_older_and_repeated_rows():
    p = started(timers.Normalizer())
    take = lambda *rows: [(r.minute, int(r.output_quantity), r.record_cnt) for r in p.handleInputRows(("d", "t", "1"), iter(rows), Now(0))]
    assert take(minute(2, 5)) == [(7, 5, 1)]
    assert take(minute(1, 9)) == [] and take(minute(2, 5)) == []
    assert take(minute(4, 6, at=8), minute(3, 1)) == [(7, -5, -1), (8, 6, 1)]
    assert take(minute(5, 6, live=False)) == [(8, -6, -1)] and take(minute(6, 2)) == [(7, 2, 1)]


def test_orders_as_of_meet_late_reports_and_deletions():
    order, rep = columns("no string"), columns("record_id string, version long")
    p = started(timers.AsOfOrders(order, rep))
    change = lambda v, no, gone=False: Row(version=v, is_deleted=gone, order=Row(no=no), report=None)
    asked = lambda v: Row(version=v, is_deleted=None, order=None, report=Row(record_id=f"r{v}", version=v))
    p.handleInitialState(("d", 1), change(0, "first"), Now(0))
    take = lambda *rows: [r.no for r in p.handleInputRows(("d", 1), iter(rows), Now(0))]
    assert take(asked(1)) == ["first"]
    assert take(asked(2), change(2, "second"), change(4, "second", True)) == ["second"]
    assert take(asked(5), asked(3), asked(1)) == [None, "second", "first"]


def test_a_line_that_never_reports_is_missed(spark, tmp_path):
    """Expected lines are the initial state; one reports once, one never."""
    spark.createDataFrame([("zh", "L1", 5000), (None, None, 40_000)], "company string, linecode string, event_ms long").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("company string, linecode string, event_ms long").parquet(str(tmp_path / "in"))
    expected = spark.createDataFrame([("zh", "L1", 1000), ("zh", "L2", 1000)], "company string, linecode string, since_ms long")
    out = timers.idle_lines(stream, timers.IdleLine(10_000, 50_000, None, event=True), "0 seconds", expected)
    sinks.start(out, sinks.rows_batch(str(tmp_path)), str(tmp_path / "c")).awaitTermination()
    got = {(r.linecode, r.level, r.changed_ms) for r in sinks.written(spark, str(tmp_path / "rows")).collect()}
    assert got == {("L1", "P3", 15_000), ("L2", "P3", 11_000)}


def test_a_records_state_expires(spark, tmp_path):
    """After its time a record is as new: nothing is taken back."""
    kinds = "db_name string, tbl_name string, record_id string, " + timers.Normalizer.HELD
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        for version in (1, 2):
            spark.createDataFrame([("d", "t", "1", *minute(version, 5))], columns(kinds)).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(columns(kinds)).parquet(str(tmp_path / "in"))
            out = timers.with_state(stream.groupBy("db_name", "tbl_name", "record_id"), timers.Normalizer(1000), timers.DELTA)
            sinks.start(out, sinks.rows_batch(str(tmp_path)), str(tmp_path / "c")).awaitTermination()
            time.sleep(1.5)
    finally:
        spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    assert [int(r.output_quantity) for r in sinks.written(spark, str(tmp_path / "rows")).collect()] == [5, 5]

"""Keyed streams on transformWithState, with the RocksDB store: alerts and snapshots with deadlines, signed deltas from the
last row of each record, and orders that change while reports come in."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from decimal import ROUND_HALF_UP, Decimal

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

import shopfloor
from shopfloor import constants as K
from shopfloor.functions import scalars as S
from shopfloor.operators.versions import RECORD
from shopfloor.operators.wide import counts
from shopfloor.schemas import MINUTE_KEY, columns
from shopfloor.streaming.buckets import BUCKETS, Bucketed

LINE_ALERT = columns("company string, linecode string, level string, alert_ms long, changed_ms long")


@contextmanager
def carried() -> Iterator[None]:
    """Within this, processors carry this package's code along: Spark starts one of their workers where it may not be
    importable."""
    cloudpickle.register_pickle_by_value(shopfloor)
    try:
        yield
    finally:
        cloudpickle.unregister_pickle_by_value(shopfloor)


def with_state(grouped, processor: StatefulProcessor, out: T.StructType, mode: str = "ProcessingTime", initial=None) -> DataFrame:
    with carried():
        return grouped.transformWithState(statefulProcessor=processor, outputStructType=out, outputMode="Update", timeMode=mode, **({} if initial is None else {"initialState": initial}))


def bucketed(rows: DataFrame, keys: list[str], processor: StatefulProcessor, out: T.StructType, mode: str = "ProcessingTime", ttl_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The same as ``with_state`` of rows grouped by ``keys``, with the keys' states in buckets."""
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    return with_state(dealt.groupBy("_bucket"), Bucketed(processor, keys, ttl_ms, mode == "EventTime"), out, mode)


class Clocked(StatefulProcessor):
    """Rows and deadlines of a key in order of time.

    On the machine's clock rows count as they come, and deadlines are in processing time. On the event clock
    (``event=True``) rows wait until the watermark has passed them, so that rows out of order count in order, and
    deadlines fall between them. One timer is pending per key, at the earliest deadline or waiting row. State expires
    ``ttl_ms`` after a key's last row: by Spark on the machine's clock, by a deadline of its own on the event clock.
    Rows have event_ms; ``WAITS`` are the columns that a waiting row keeps.
    """

    WAITS = columns("event_ms long")

    def __init__(self, event: bool = False, ttl_ms: int | None = K.STATE_TTL_MS):
        self.event, self.ttl_ms = event, ttl_ms

    @property
    def ttl(self) -> int | None:
        return None if self.event else self.ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.event:
            self.waiting = handle.getListState("waiting", self.WAITS)
            self.used = handle.getValueState("used", columns("last_ms long"))

    # What a processor does: read its state, take a row or a deadline that has come, and write its state.
    def load(self) -> None: ...

    def take(self, key, row, now: int) -> Iterator[Row]: ...

    def due(self) -> int | None: ...

    def fire(self, key, at: int) -> Iterator[Row]: ...

    def save(self) -> None: ...

    def forget(self) -> None: ...

    def ahead(self) -> bool:
        """Whether the next deadline goes before a row of the same time."""
        return False

    @staticmethod
    def order(row):
        return row.event_ms

    def _alarm(self, *times: int | None) -> None:
        at, old = min((t for t in times if t is not None), default=None), list(self.handle.listTimers())
        for t in old:
            if t != at:
                self.handle.deleteTimer(t)
        if at is not None and at not in old:
            self.handle.registerTimer(at)

    def _until(self, key, rows: list, now: int) -> Iterator[Row]:
        """All rows, and all deadlines up to now, in order."""
        for row in rows:
            at = row.event_ms if self.event else now
            while (due := self.due()) is not None and (due < at or due == at and self.ahead()):
                yield from self.fire(key, due)
            yield from self.take(key, row, at)
        while (due := self.due()) is not None and due <= now:
            yield from self.fire(key, due)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if None in tuple(key):  # the clock's own rows
            return
        if self.event:
            new = [tuple(r[c] for c in self.WAITS.fieldNames()) for r in rows]
            self.waiting.appendList(new)
            self._alarm(*self.handle.listTimers(), min(r[self.WAITS.fieldNames().index("event_ms")] for r in new))
            return
        self.load()
        yield from self._until(key, sorted(rows, key=self.order), timerValues.getCurrentProcessingTimeInMs())
        self.save()
        self._alarm(self.due())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.load()
        if not self.event:
            yield from self._until(key, [], expiredTimerInfo.getExpiryTimeInMs())
            self.save()
            self._alarm(self.due())
            return
        now, kind = timerValues.getCurrentWatermarkInMs(), Row(*self.WAITS.fieldNames())
        held = sorted((kind(*r) for r in self.waiting.get()), key=self.order) if self.waiting.exists() else []
        ready, rest = [r for r in held if r.event_ms <= now], [r for r in held if r.event_ms > now]
        last = max([r.event_ms for r in ready] + [self.used.get()[0] if self.used.exists() else 0])
        yield from self._until(key, ready, now)
        ends = last + self.ttl_ms if self.ttl_ms else None
        if rest:
            self.waiting.put([tuple(r) for r in rest])
        elif held:
            self.waiting.clear()
        if ends is not None and ends <= now and not rest:
            self.forget()
            self.used.clear()
            self._alarm()
            return
        self.save()
        self.used.update((last,))
        self._alarm(self.due(), rest[0].event_ms if rest else None, ends)

    def close(self) -> None:
        pass


class IdleLine(Clocked):
    """P3 when a line has had no report for ``idle_ms``, a level more after each ``escalate_ms``, NONE at the next report.

    The lines that should report may be the initial state, each with the time (since_ms) from which it is waited for.
    """

    def __init__(self, idle_ms: int = K.IDLE_SECONDS * 1000, escalate_ms: int = K.ESCALATE_SECONDS * 1000, ttl_ms: int | None = K.STATE_TTL_MS, event: bool = False):
        super().__init__(event, ttl_ms)
        self.idle_ms, self.escalate_ms = idle_ms, escalate_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.state = handle.getValueState("line", columns("level integer, alert_ms long, due_ms long"), ttlDurationMs=self.ttl)

    def load(self) -> None:
        self.level, self.since, self.next = self.state.get() if self.state.exists() else (0, 0, 0)

    def save(self) -> None:
        self.state.update((self.level, self.since, self.next))

    def forget(self) -> None:
        self.state.clear()

    def due(self) -> int | None:
        return self.next or None

    def ahead(self) -> bool:
        return self.level == 0  # a gap of just the threshold is one, but no level is due at the moment of recovery

    def _row(self, key, now: int) -> Row:
        return Row(company=key[0], linecode=key[1], level=K.LEVELS[self.level], alert_ms=self.since, changed_ms=now)

    def take(self, key, row, now: int) -> Iterator[Row]:
        if self.level:
            self.level = 0
            yield self._row(key, now)
        self.since, self.next = 0, now + self.idle_ms

    def fire(self, key, at: int) -> Iterator[Row]:
        self.level, self.since = min(self.level + 1, len(K.LEVELS) - 1), self.since or at
        self.next = at + self.escalate_ms if self.level < len(K.LEVELS) - 1 else 0
        yield self._row(key, at)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        since = initialState["since_ms"] if self.event else timerValues.getCurrentProcessingTimeInMs()
        self.state.update((0, 0, since + self.idle_ms))
        self.handle.registerTimer(since + self.idle_ms)
        if self.event:
            self.used.update((since,))


ORDER_ALERT = columns("company string, datasource string, productionorder string, alert_type string, level string, report_quantity decimal(38,4), alert_ms long, recover_ms long, changed_ms long")
SNAPSHOT = columns("company string, datasource string, productionorder string, order_quantity long, report_quantity decimal(38,4), achieve_rate decimal(10,4), plan_progress decimal(10,4), last_ms long, version long")
PLACES = Decimal("0.0001")
KEY = ["company", "datasource", "productionorder"]


def share(part: Decimal | int, whole: int) -> Decimal:
    """Rounded half up at four places; 0 where whole isn't above 0."""
    return (Decimal(part) / whole).quantize(PLACES, ROUND_HALF_UP) if whole > 0 else Decimal(0)


def progress(created: int, due: int, now: int) -> Decimal:
    """The share of an order's time that is gone; 0 where its dates are missing or due isn't later."""
    return share(max(0, min(now, due) - created), due - created) if created and due > created else Decimal(0)


SENT = columns("channel string, company string, alert_type string, event_ms long, sent boolean")


class RollingLimit(Clocked):
    """A channel's messages in order of time: one is sent unless ``most`` were sent in the ``window_ms`` up to it, the
    moment at which the window began included; those not sent don't count. State is the times of at most ``most`` sent."""

    WAITS = columns("company string, alert_type string, event_ms long")

    def __init__(self, most: int = K.DIGESTS_PER_MINUTE, window_ms: int = 60_000, event: bool = False, ttl_ms: int | None = K.STATE_TTL_MS):
        super().__init__(event, ttl_ms)
        self.most, self.window_ms = most, window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.times = handle.getListState("sent", columns("at_ms long"), ttlDurationMs=self.ttl)

    @staticmethod
    def order(row):
        return (row.event_ms, row.company or "", row.alert_type or "")

    def load(self) -> None:
        self.sent = [t[0] for t in self.times.get()] if self.times.exists() else []

    def save(self) -> None:
        if self.sent:
            self.times.put([(t,) for t in self.sent])
        elif self.times.exists():
            self.times.clear()

    def forget(self) -> None:
        self.times.clear()

    def take(self, key, row, now: int) -> Iterator[Row]:
        self.sent = [t for t in self.sent if now - t <= self.window_ms]
        free = len(self.sent) < self.most
        if free:
            self.sent.append(now)
        yield Row(channel=key[0], company=row.company, alert_type=row.alert_type, event_ms=now, sent=free)

    def due(self) -> int | None:
        return None


class OrderState(Clocked):
    """The sum of an order's reports, of which each counts with its last version, older ones not at all. Rows have
    record_id, version, qty, is_deleted, event_ms, order_quantity, created_ms and due_ms. Those of a batch count in order
    of version on the machine's clock, those that have waited in order of time on the event clock."""

    WAITS = columns("record_id string, version long, qty decimal(38,4), is_deleted boolean, event_ms long, order_quantity long, created_ms long, due_ms long")

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.order_state = handle.getValueState("order", columns("qty decimal(38,4), order_quantity long, created_ms long, due_ms long, last_ms long"), ttlDurationMs=self.ttl)
        self.records = handle.getMapState("records", columns("record_id string"), columns("qty decimal(38,4), version long"), ttlDurationMs=self.ttl)

    def order(self, row):
        return (row.event_ms, row.record_id, row.version) if self.event else (row.version, row.event_ms)

    def load(self) -> None:
        found = self.order_state.get() if self.order_state.exists() else None
        self.known = found is not None
        self.qty, self.ordered, self.created, self.until, self.last = found or (Decimal(0), 0, 0, 0, 0)

    def save(self) -> None:
        if self.known:
            self.order_state.update((self.qty, self.ordered, self.created, self.until, self.last))

    def forget(self) -> None:
        self.order_state.clear()
        self.records.clear()

    def counted(self, r) -> bool:
        """Adds a row up, unless its record has a later version."""
        key = (r.record_id,)
        old, version = self.records.getValue(key) if self.records.containsKey(key) else (Decimal(0), -1)
        if r.version <= version:
            return False
        new = Decimal(0) if r.is_deleted else r.qty or Decimal(0)
        # a deletion stays, at 0, so that an older version that comes late doesn't bring the record back
        self.records.updateValue(key, (new, r.version))
        self.known, self.qty, self.last = True, self.qty + new - old, max(self.last, r.event_ms)
        self.ordered, self.created, self.until = r.order_quantity or 0, r.created_ms or 0, r.due_ms or 0
        return True


class OrderAlerts(OrderState):
    """OVER_REPORT once the sum is above the order's quantity times ``ratio``, for good; LAG while the rate is more than
    ``threshold`` behind the plan at a report's time. Both begin at P3 and rise a level after each ``escalate_ms``, each
    by a deadline of its own."""

    KINDS = ("OVER_REPORT", "LAG")

    def __init__(self, ratio: float = K.OVER_RATIO, threshold: float = K.LAG_THRESHOLD, escalate_ms: int = K.ESCALATE_SECONDS * 1000, event: bool = False, ttl_ms: int | None = K.STATE_TTL_MS):
        super().__init__(event, ttl_ms)
        self.ratio, self.threshold, self.escalate_ms = Decimal(str(ratio)), Decimal(str(threshold)), escalate_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.alerts = handle.getMapState("alerts", columns("kind string"), columns("level integer, alert_ms long, due_ms long"), ttlDurationMs=self.ttl)

    def load(self) -> None:
        super().load()
        # level, when the alert began, and when it rises (0: not any more)
        self.of = {k: tuple(self.alerts.getValue((k,))) if self.alerts.containsKey((k,)) else (0, 0, 0) for k in self.KINDS}
        self.was = dict(self.of)

    def save(self) -> None:
        super().save()
        for kind, state in self.of.items():
            if state != self.was[kind]:
                self.alerts.updateValue((kind,), state)

    def forget(self) -> None:
        super().forget()
        self.alerts.clear()

    def _set(self, key, kind: str, level: int, since: int, now: int, recovered: int = 0) -> Row:
        self.of[kind] = (level, since, now + self.escalate_ms if 0 < level < len(K.LEVELS) - 1 else 0)
        return Row(company=key[0], datasource=key[1], productionorder=key[2], alert_type=kind, level=K.LEVELS[level], report_quantity=self.qty, alert_ms=since, recover_ms=recovered, changed_ms=now)

    def take(self, key, row, now: int) -> Iterator[Row]:
        if not self.counted(row) or self.ordered <= 0:
            return
        if self.qty > self.ordered * self.ratio and not self.of["OVER_REPORT"][0]:
            yield self._set(key, "OVER_REPORT", 1, row.event_ms, now)
        if self.created and self.until > self.created:
            lags = share(self.qty, self.ordered) < progress(self.created, self.until, row.event_ms) - self.threshold
            level, since, _ = self.of["LAG"]
            if lags and not level:
                yield self._set(key, "LAG", 1, row.event_ms, now)
            elif level and not lags:
                yield self._set(key, "LAG", 0, since, now, now)

    def due(self) -> int | None:
        return min((at for _, _, at in self.of.values() if at), default=None)

    def fire(self, key, at: int) -> Iterator[Row]:
        for kind, (level, since, due) in list(self.of.items()):
            if due == at:
                yield self._set(key, kind, level + 1, since, at)


class OrderSnapshots(OrderState):
    """The order's achievement, at most once in ``every_ms``, by a deadline that the first change after the last one sets."""

    def __init__(self, every_ms: int = K.SNAPSHOT_SECONDS * 1000, event: bool = False, ttl_ms: int | None = K.STATE_TTL_MS):
        super().__init__(event, ttl_ms)
        self.every_ms = every_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.next_state = handle.getValueState("next", columns("due_ms long"), ttlDurationMs=self.ttl)

    def load(self) -> None:
        super().load()
        self.next = self.next_state.get()[0] if self.next_state.exists() else 0

    def save(self) -> None:
        super().save()
        self.next_state.update((self.next,))

    def forget(self) -> None:
        super().forget()
        self.next_state.clear()

    def take(self, key, row, now: int) -> Iterator[Row]:
        if self.counted(row) and not self.next:
            self.next = now + self.every_ms
        return iter(())

    def due(self) -> int | None:
        return self.next or None

    def fire(self, key, at: int) -> Iterator[Row]:
        self.next = 0
        if self.known:
            yield Row(company=key[0], datasource=key[1], productionorder=key[2], order_quantity=self.ordered, report_quantity=self.qty, achieve_rate=share(self.qty, self.ordered), plan_progress=progress(self.created, self.until, at), last_ms=self.last, version=at)


def clocked(rows: DataFrame, delay: str) -> DataFrame:
    """Rows with the event clock: event_time from event_ms, and a watermark."""
    return rows.withColumn("event_time", F.timestamp_millis("event_ms")).withWatermark("event_time", delay)


def keyed(rows: DataFrame, keys: list[str], processor: Clocked, out: T.StructType, delay: str, initial: DataFrame | None) -> DataFrame:
    """Keys in buckets; with an initial state, which Spark hands over key by key, each is its own."""
    rows, mode = clocked(rows, delay) if processor.event else rows, "EventTime" if processor.event else "ProcessingTime"
    if initial is None:
        return bucketed(rows, keys, processor, out, mode, processor.ttl)
    return with_state(rows.groupBy(*keys), processor, out, mode, initial.groupBy(*keys))


#: How far out of order rows may be on the event clock; later ones are dropped and counted by Spark.
DELAY = f"{K.WATERMARK_SECONDS + K.LATENESS_SECONDS} seconds"


def idle_lines(reports: DataFrame, processor: IdleLine | None = None, delay: str = DELAY, expected: DataFrame | None = None) -> DataFrame:
    """Level changes of the lines of a stream with company and linecode, and event_ms on the event clock. ``expected``
    (company, linecode, since_ms) are lines that are waited for though they never report."""
    processor = processor or IdleLine()
    rows = reports if processor.event else reports.withColumn("event_ms", F.lit(0).cast("bigint"))
    return keyed(rows, ["company", "linecode"], processor, LINE_ALERT, delay, expected)


def order_alerts(rows: DataFrame, processor: OrderAlerts | None = None, delay: str = DELAY) -> DataFrame:
    """Level changes of the orders' alerts."""
    return keyed(rows, KEY, processor or OrderAlerts(), ORDER_ALERT, delay, None)


def order_snapshots(rows: DataFrame, processor: OrderSnapshots | None = None, delay: str = DELAY) -> DataFrame:
    return keyed(rows, KEY, processor or OrderSnapshots(), SNAPSHOT, delay, None)


def limited(messages: DataFrame, processor: RollingLimit | None = None, delay: str = DELAY) -> DataFrame:
    """A stream of messages with channel, company, alert_type and, on the event clock, event_ms; each with whether it is
    sent."""
    processor = processor or RollingLimit()
    rows = messages if processor.event else messages.withColumn("event_ms", F.lit(0).cast("bigint"))
    return keyed(rows, ["channel"], processor, SENT, delay, None)


def millis(ts: Column) -> Column:
    """Milliseconds of a wall clock."""
    return S.epoch(ts) * 1000


def alert_rows(live: DataFrame) -> DataFrame:
    """Wide rows as the processors of orders and lines take them."""
    return live.select(*KEY, "linecode", F.concat_ws(":", "record_id", "outputtype").alias("record_id"), "version", F.col("lotquantity").alias("qty"), "is_deleted", millis(F.col("outputdatetime")).alias("event_ms"), F.col("orderquantity").alias("order_quantity"), millis(F.col("ordercreateddate")).alias("created_ms"), millis(F.col("orderduedate")).alias("due_ms"))


def wall(ms: Column) -> Column:
    """The wall clock of milliseconds."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (ms / 1000).cast("decimal(18,6)"))


class Normalizer(StatefulProcessor):
    """What a record's last row adds to the minutes is kept as its state; a newer one takes that back and adds its own, an
    older or repeated one does nothing. Rows have version, seq, live, the minute's key, linename and qty."""

    HELD = "version long, seq long, live boolean, minute long, company string, workshop string, linecode string, partcode string, linename string, qty decimal(38,4)"

    def __init__(self, ttl_ms: int | None = K.STATE_TTL_MS):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", columns(self.HELD), ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names = columns(self.HELD).fieldNames()
        new = max((tuple(r[c] for c in names) for r in rows), key=lambda r: r[:2])
        old = self.last.get() if self.last.exists() else None
        if old is not None and tuple(old[:2]) >= new[:2]:
            return
        self.last.update(new)
        for row, sign in ((old, -1), (new, 1)):
            if row is not None and row[2]:
                yield Row(**dict(zip(names[3:9], row[3:9], strict=True)), output_quantity=sign * row[9], record_cnt=sign)

    def close(self) -> None:
        pass


DELTA = columns("minute long, company string, workshop string, linecode string, partcode string, linename string, output_quantity decimal(38,4), record_cnt long")


def minute_deltas(wide: DataFrame, processor: Normalizer | None = None) -> DataFrame:
    """Signed minute rows of a stream of wide rows, from keyed state alone."""
    rows = wide.select(*RECORD, "version", F.col("seq").cast("bigint").alias("seq"), F.coalesce(counts(wide) & ~F.col("is_deleted"), F.lit(False)).alias("live"), (F.floor(S.epoch(F.col("outputdatetime")) / 60)).alias("minute"), "company", "workshop", "linecode", "partcode", "linename", F.col("lotquantity").alias("qty"))
    processor = processor or Normalizer()
    out = bucketed(rows, RECORD, processor, DELTA, ttl_ms=processor.ttl_ms)
    at = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("minute").cast("int"))
    return out.withColumn("ts_minute", at).select(*MINUTE_KEY, "linename", "output_quantity", "record_cnt")


class AsOfOrders(StatefulProcessor):
    """An order's versions as state, deletions among them; each report gets the last one that isn't later than itself.

    A report may come late, for all versions stay until the state expires, but not before its order's change has. The
    orders that there are already may be the initial state.
    """

    def __init__(self, order: T.StructType, report: T.StructType, ttl_ms: int | None = K.STATE_TTL_MS):
        self.names, self.report, self.ttl_ms = order.fieldNames(), report.fieldNames(), ttl_ms
        self.order = T.StructType([T.StructField("is_deleted", T.BooleanType()), *order.fields])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.versions = handle.getMapState("versions", columns("version long"), self.order, ttlDurationMs=self.ttl_ms)

    def _keep(self, row) -> None:
        self.versions.updateValue((row.version,), (row.is_deleted, *(row.order[c] for c in self.names)))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        reports = []
        for r in rows:
            if r.report is None:
                self._keep(r)
            else:
                reports.append(r)
        if not reports:
            return
        known = sorted(((k[0], tuple(v)) for k, v in self.versions.iterator()), key=lambda kv: kv[0]) if self.versions.exists() else []
        for r in reports:
            met = next((v for at, v in reversed(known) if at <= r.version), None)
            found = met[1:] if met and not met[0] else (None,) * len(self.names)
            yield Row(**dict(zip(self.report, (r.report[c] for c in self.report), strict=True)), **dict(zip(self.names, found, strict=True)))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._keep(initialState)

    def close(self) -> None:
        pass


def orders_as_of(reports: DataFrame, orders: DataFrame, snapshot: DataFrame | None = None, ttl_ms: int | None = K.STATE_TTL_MS) -> DataFrame:
    """A stream of reports with their orders, as ``asof_order_join`` gives them in batch; ``orders`` is a stream of changes
    (with op and version), ``snapshot`` a table of such from before it began."""
    keys = ["db_name", "productionorderid"]
    names = [c for c in orders.columns if c not in (*keys, "version", "op")]
    held = lambda d: d.select(*keys, "version", (F.col("op") == "d").alias("is_deleted"), F.struct(*names).alias("order"))
    kinds = T.StructType([f for f in orders.schema if f.name in names]), T.StructType([f for f in reports.schema])
    one = reports.select(*keys, "version", F.lit(None).cast("boolean").alias("is_deleted"), F.lit(None).cast(kinds[0]).alias("order"), F.struct(*reports.columns).alias("report"))
    both = one.unionByName(held(orders).withColumn("report", F.lit(None).cast(kinds[1])))
    out = T.StructType([*kinds[1].fields, *kinds[0].fields])
    if snapshot is None:
        return bucketed(both, keys, AsOfOrders(*kinds, ttl_ms), out, ttl_ms=ttl_ms)
    return with_state(both.groupBy(*keys), AsOfOrders(*kinds, ttl_ms), out, initial=held(snapshot).groupBy(*keys))

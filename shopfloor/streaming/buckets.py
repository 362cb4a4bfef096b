"""Many small keys in buckets: Spark's state has one value and one timer for each bucket, so that a call between Spark and
Python serves all of a bucket's keys that a batch touches."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from shopfloor.schemas import columns

#: Buckets of a stream's keys. A batch reads and writes those that it touches whole, one at a time in memory.
BUCKETS = 4096


class Inside:
    """The handle that the processor of keys gets: states and timers of the key whose turn it is, in plain values."""

    def __init__(self) -> None:
        self.now, self.slots, self.timers = 0, {}, set()

    def getValueState(self, name: str, schema, ttlDurationMs: int | None = None) -> Value:
        return Value(self, name, ttlDurationMs)

    def getListState(self, name: str, schema, ttlDurationMs: int | None = None) -> Listed:
        return Listed(self, name, ttlDurationMs)

    def getMapState(self, name: str, key, schema, ttlDurationMs: int | None = None) -> Mapped:
        return Mapped(self, name, ttlDurationMs)

    def listTimers(self) -> Iterator[int]:
        return iter(sorted(self.timers))

    def registerTimer(self, at: int) -> None:
        self.timers.add(at)

    def deleteTimer(self, at: int) -> None:
        self.timers.discard(at)


class Value:
    """A state as (value, the time from which it has expired, or None)."""

    def __init__(self, handle: Inside, name: str, ttl: int | None):
        self.handle, self.name, self.ttl = handle, name, ttl

    def ends(self) -> int | None:
        return self.handle.now + self.ttl if self.ttl else None

    def exists(self) -> bool:
        return self.name in self.handle.slots

    def get(self):
        return self.handle.slots[self.name][0] if self.exists() else None

    def update(self, value) -> None:
        self.handle.slots[self.name] = (tuple(value), self.ends())

    def clear(self) -> None:
        self.handle.slots.pop(self.name, None)


class Listed(Value):
    def get(self):
        return iter(super().get() or ())

    def put(self, rows) -> None:
        self.handle.slots[self.name] = ([tuple(r) for r in rows], self.ends())

    def appendList(self, rows) -> None:
        self.put([*self.get(), *rows])


class Mapped(Value):
    """Entries expire one by one."""

    def _of(self) -> dict:
        return self.handle.slots.get(self.name, {})

    def containsKey(self, key) -> bool:
        return tuple(key) in self._of()

    def getValue(self, key):
        found = self._of().get(tuple(key))
        return found[0] if found else None

    def updateValue(self, key, value) -> None:
        self.handle.slots.setdefault(self.name, {})[tuple(key)] = (tuple(value), self.ends())

    def iterator(self):
        return iter([(k, v[0]) for k, v in self._of().items()])


def alive(slots: dict, now: int) -> dict:
    """The states that have not expired."""
    out = {}
    for name, held in slots.items():
        if isinstance(held, dict):
            held = {k: v for k, v in held.items() if v[1] is None or v[1] > now}
            if held:
                out[name] = held
        elif held[1] is None or held[1] > now:
            out[name] = held
    return out


class Expired:
    def __init__(self, at: int):
        self.at = at

    def getExpiryTimeInMs(self) -> int:
        return self.at


class Bucketed(StatefulProcessor):
    """A processor of single keys at work for all keys of a bucket, each with states, expiry and timers of its own.

    ``inner`` is any processor of this package, ``keys`` are the columns it is keyed by. One timer is pending per bucket,
    at the earliest of its keys'. A bucket expires as a whole once all of its keys have.
    """

    def __init__(self, inner: StatefulProcessor, keys: list[str], ttl_ms: int | None, event: bool = False):
        self.inner, self.keys, self.ttl_ms, self.event = inner, keys, ttl_ms, event

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.inside = handle, Inside()
        self.bucket = handle.getValueState("bucket", columns("held binary"), ttlDurationMs=self.ttl_ms)
        self.inner.init(self.inside)

    def _load(self, timerValues) -> dict:
        """Slots and timers by key."""
        self.inside.now = 0 if self.ttl_ms is None else timerValues.getCurrentProcessingTimeInMs()
        found = self.bucket.get()
        held = pickle.loads(bytes(found[0])) if found else {}
        return held if self.ttl_ms is None else {k: (alive(slots, self.inside.now), timers) for k, (slots, timers) in held.items()}

    def _save(self, held: dict, after: int | None = None) -> None:
        held = {k: v for k, v in held.items() if v[0] or v[1]}
        if held:
            self.bucket.update((pickle.dumps(held, 5),))
        elif self.bucket.exists():
            self.bucket.clear()
        at, old = min((min(timers) for _, timers in held.values() if timers), default=None), list(self.handle.listTimers())
        # a timer that has come is Spark's to delete, and must not be taken for one that is set
        at = at if at is None or after is None else max(at, after + 1)
        for t in old:
            if t != at:
                self.handle.deleteTimer(t)
        if at is not None and at not in old:
            self.handle.registerTimer(at)

    def _enter(self, held: dict, key: tuple) -> None:
        self.inside.slots, self.inside.timers = held.setdefault(key, ({}, set()))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        groups: dict[tuple, list[Row]] = {}
        for r in rows:
            groups.setdefault(tuple(r[c] for c in self.keys), []).append(r)
        held = self._load(timerValues)
        for own, mine in groups.items():
            self._enter(held, own)
            yield from self.inner.handleInputRows(own, iter(mine), timerValues)
        self._save(held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # on the event clock a processor takes all that the watermark has passed, on the machine's what this timer has
        until = timerValues.getCurrentWatermarkInMs() if self.event else expiredTimerInfo.getExpiryTimeInMs()
        held = self._load(timerValues)
        for own in [k for k, (_, timers) in held.items() if timers and min(timers) <= until]:
            self._enter(held, own)
            at = min(self.inside.timers)
            self.inside.timers.discard(at)
            yield from self.inner.handleExpiredTimer(own, timerValues, Expired(at))
        self._save(held, until)

    def close(self) -> None:
        self.inner.close()

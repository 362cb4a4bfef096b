"""Keys in buckets: the same results as one state a key, with one exchange between Spark and Python for each bucket."""

import pytest
from pyspark.sql import Row

from shopfloor.streaming import timers
from shopfloor.streaming.buckets import Bucketed
from tests.test_timers import HELD, Handle, Now, Value, minute, report, started, until

KEYS = ["company", "datasource", "productionorder"]


class Counted(Value):
    calls = 0

    def get(self):
        Counted.calls += 1
        return super().get()

    def update(self, value):
        Counted.calls += 1
        super().update(value)


class Counting(Handle):
    def getValueState(self, *_, **__):
        return Counted()


def of(order: str, row: Row) -> Row:
    return Row(company="zh", datasource="OLD_MES", productionorder=order, **row.asDict())


def bucket(inner, keys=KEYS, ttl=None):
    p = Bucketed(inner, keys, ttl, getattr(inner, "event", False))
    p.init(Counting())
    return p


def test_orders_of_a_bucket_share_its_calls():
    Counted.calls = 0
    p = bucket(timers.OrderSnapshots(10, event=True, ttl_ms=None))
    assert not list(p.handleInputRows((7,), [of(f"O{k}", report("1", 1, k, 100 + k)) for k in range(500)], Now(0)))
    assert Counted.calls <= 2 and p.handle.timers == {100}
    got = until(p, (7,), 10_000)
    assert sorted((r.productionorder, r.version, r.report_quantity) for r in got) == sorted((f"O{k}", 110 + k, k) for k in range(500))
    assert Counted.calls <= 4 and not p.handle.timers


@pytest.mark.parametrize("event", [True, False])
def test_a_bucket_gives_what_its_keys_give_alone(event):
    rows = {"A": [report("1", 1, 10, 500), report("2", 1, 60, 600), report("3", 2, 30, 900)], "B": [report("1", 1, 150, 510), report("1", 2, 5, 950)], "C": [report("9", 1, 1, 990, True)]}
    make = lambda: timers.OrderAlerts(escalate_ms=30, event=event, ttl_ms=None)
    clock = (0, 650, 1200)
    alone = []
    for name, mine in rows.items():
        p, key = started(make()), ("zh", "OLD_MES", name)
        for at, k in zip(clock, range(3), strict=True):
            alone += list(p.handleInputRows(key, mine[k : k + 1], Now(at))) if mine[k : k + 1] else []
            alone += until(p, key, at)
        alone += until(p, key, 5000)
    p, together = bucket(make()), []
    for at, k in zip(clock, range(3), strict=True):
        together += list(p.handleInputRows((7,), [of(name, r) for name, mine in rows.items() for r in mine[k : k + 1]], Now(at)))
        together += until(p, (7,), at)
    together += until(p, (7,), 5000)
    assert together and sorted(together, key=repr) == sorted(alone, key=repr)


def test_records_of_a_bucket_expire_one_by_one():
    p = bucket(timers.Normalizer(1000), ["record_id"], 1000)
    one = lambda record, version, at: [int(r.output_quantity) for r in p.handleInputRows((7,), [Row(record_id=record, **dict(zip(HELD, tuple(minute(version, 5)), strict=True)))], Now(at))]
    assert one("1", 1, 0) == [5] and one("2", 1, 600) == [5]
    assert one("1", 2, 1100) == [5] and one("2", 2, 1200) == [-5, 5]


def test_the_clocks_own_rows_leave_no_state():
    p = bucket(timers.OrderSnapshots(10, event=True, ttl_ms=None))
    blank = Row(company=None, datasource=None, productionorder=None, event_ms=5)
    assert not list(p.handleInputRows((7,), [blank], Now(0))) and not p.handle.timers and not p.bucket.exists()

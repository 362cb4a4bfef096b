"""Shift days, rates, plan progress, site names and alert ids as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shopfloor import constants as K

SHIFT = f"interval {K.SHIFT_MINUTES} minutes"


def shift_date(ts: Column) -> Column:
    """The day whose shift a time belongs to: days start at 08:30."""
    return F.to_date(ts - F.expr(SHIFT))


def shift_start(day: Column) -> Column:
    return day.cast("timestamp_ntz") + F.expr(SHIFT)


def shift_end(day: Column) -> Column:
    """The end, which is excluded."""
    return shift_start(day) + F.expr("interval 24 hours")


def shift_epoch_day(ts: Column) -> Column:
    return F.unix_date(shift_date(ts))


def minute_floor(ts: Column) -> Column:
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def is_day_shift(ts: Column) -> Column:
    return (F.hour(ts) * 60 + F.minute(ts)).between(K.SHIFT_MINUTES, 17 * 60 + 30)


def epoch(ts: Column) -> Column:
    """Seconds of a wall clock."""
    day = F.to_date(ts)
    return F.unix_date(day).cast("bigint") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def company(db_name: Column) -> Column:
    return F.nullif(F.regexp_extract(db_name, "^mes_(?:old|new)_(.+)$", 1), F.lit(""))


def datasource(db_name: Column, parity: str | None = None) -> Column:
    """Null for an unknown prefix; parity="sql" calls everything that isn't old new."""
    old, new = K.DATASOURCES
    known = F.when(db_name.startswith(old), K.DATASOURCES[old])
    return known.otherwise(K.DATASOURCES[new]) if parity == "sql" else known.when(db_name.startswith(new), K.DATASOURCES[new])


def channel(tbl_name: Column) -> Column:
    return reduce(lambda c, kv: c.when(tbl_name == kv[0], kv[1]), K.CHANNELS.items(), F.when(F.lit(False), F.lit(None).cast("string")))


def rate4(part: Column, whole: Column) -> Column:
    """part / whole rounded half up at four places, once; 0 where whole isn't above 0."""
    quotient = part.cast("decimal(24,4)") / whole.cast("decimal(13,0)")
    return F.when(whole > 0, F.round(quotient, 4)).otherwise(F.lit(0)).cast("decimal(10,4)")


def plan_progress(created: Column, due: Column, now: Column) -> Column:
    """Share of the plan's time gone by, 0 to 1 at four places; 0 where created is missing or due isn't later."""
    gone, span = epoch(now) - epoch(created), epoch(due) - epoch(created)
    share = F.round(F.greatest(F.lit(0), F.least(gone, span)).cast("decimal(18,0)") / span.cast("decimal(13,0)"), 4)
    return F.when(created.isNotNull() & (span > 0), share).otherwise(F.lit(0)).cast("decimal(10,4)")


def is_finished(achieve: Column, due: Column, now: Column) -> Column:
    return F.coalesce((achieve >= 1) & (now >= due), F.lit(False))


def parse_time(text: Column) -> Column:
    """A wall clock, with a T or a space; null if it isn't one."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def parse_op_ts(text: Column) -> Column:
    """Milliseconds of an instant; 0 if it isn't one."""
    return F.coalesce(F.unix_millis(F.try_to_timestamp(text)), F.lit(0))


def escalate(level: Column) -> Column:
    up = dict(zip(K.LEVELS, (*K.LEVELS[1:], K.LEVELS[-1]), strict=True))
    return F.create_map(*[F.lit(x) for kv in up.items() for x in kv])[level]


def order_alert_id(kind: str) -> Column:
    return F.concat_ws(":", F.lit(kind), "company", "datasource", "productionorder")


def line_alert_id() -> Column:
    return F.concat_ws(":", F.lit("MISSING_REPORT"), "company", "linecode")


def partition_day(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd")

"""Alerts in replay form: event time is the clock, and now or as_of is always given."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor import constants as K
from shopfloor.functions import scalars as S
from shopfloor.operators.orders import GRAINS, order_running_qty
from shopfloor.operators.versions import latest_by_version

NO_TIME = "cast(null as timestamp_ntz)"
COLUMNS = ["alert_id", "alert_type", "company", "linecode", "productionorder", "order_quantity", "report_quantity", "achieve_rate", "alert_time", "recover_time"]


def over_report_alerts(live: DataFrame, ratio: float = K.OVER_RATIO, grain: str = "order_shift") -> DataFrame:
    """The first report that takes an order above its quantity times ratio; it never recovers."""
    over = order_running_qty(live.where("productionorder is not null"), grain).where((F.col("orderquantity") > 0) & (F.col("running_qty") > F.col("orderquantity") * F.lit(ratio)))
    first = Window.partitionBy(*GRAINS[grain]).orderBy("outputdatetime", "record_id", "outputtype")
    out = over.withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return shaped(out, "OVER_REPORT", grain, F.col("outputdatetime"), F.expr(NO_TIME))


def lag_alerts(live: DataFrame, threshold: float = K.LAG_THRESHOLD, grain: str = "order_shift") -> DataFrame:
    """Episodes in which an order's rate is more than threshold behind its plan; the first report that isn't ends one."""
    created, due, qty = F.col("ordercreateddate"), F.col("orderduedate"), F.col("orderquantity")
    rows = order_running_qty(live.where("productionorder is not null"), grain)
    able = (qty > 0) & created.isNotNull() & (S.epoch(due) > S.epoch(created))
    rows = rows.withColumn("rate", S.rate4(F.col("running_qty"), qty)).withColumn("plan", S.plan_progress(created, due, F.col("outputdatetime")))
    rows = rows.withColumn("lags", F.coalesce(able & (F.col("rate") < F.col("plan") - F.lit(threshold).cast("decimal(10,4)")), F.lit(False)))
    w = Window.partitionBy(*GRAINS[grain]).orderBy("outputdatetime", "record_id", "outputtype")
    turns = rows.withColumn("_was", F.coalesce(F.lag("lags").over(w), F.lit(False))).where("lags <> _was")
    turns = turns.withColumn("_until", F.lead("outputdatetime").over(w)).where("lags")
    return shaped(turns, "LAG", grain, F.col("outputdatetime"), F.col("_until"))


def shaped(rows: DataFrame, kind: str, grain: str, at: Column, until: Column) -> DataFrame:
    rate = S.rate4(F.col("running_qty"), F.col("orderquantity"))
    out = rows.withColumns({"alert_id": S.order_alert_id(kind), "alert_type": F.lit(kind), "order_quantity": F.col("orderquantity"), "report_quantity": F.col("running_qty"), "achieve_rate": rate, "alert_time": at, "recover_time": until})
    return out.select(*COLUMNS, *(["shift_date"] if "shift_date" in GRAINS[grain] else []))


def missing_report_alerts(live: DataFrame, as_of: Column, idle_seconds: int = K.IDLE_SECONDS, keep_empty: bool = False) -> DataFrame:
    """Lines without a report for idle_seconds or more; the next report recovers. Reports without a line are left out
    unless keep_empty."""
    rows = (live if keep_empty else live.where(F.coalesce("linecode", F.lit("")) != "")).where(F.col("outputdatetime") <= as_of)
    # no gap of idle_seconds lies inside a stretch of that length, so a line's stretches are ordered, not its reports
    stretch = F.floor(S.epoch(F.col("outputdatetime")) / max(1, idle_seconds)).alias("stretch")
    each = rows.groupBy("company", "linecode", stretch).agg(F.min("outputdatetime").alias("_first"), F.max("outputdatetime").alias("outputdatetime"))
    gaps = each.withColumn("_next", F.lead("_first").over(Window.partitionBy("company", "linecode").orderBy("stretch")))
    idle = F.expr(f"interval {idle_seconds} seconds")
    out = gaps.where(F.coalesce("_next", as_of) >= F.col("outputdatetime") + idle)
    none = lambda t: F.lit(None).cast(t)
    return out.withColumns({"alert_id": S.line_alert_id(), "alert_type": F.lit("MISSING_REPORT"), "productionorder": none("string"), "order_quantity": none("bigint"), "report_quantity": none("decimal(38,4)"), "achieve_rate": none("decimal(10,4)"), "alert_time": F.col("outputdatetime") + idle, "recover_time": F.col("_next")}).select(*COLUMNS)


def all_alerts(*kinds: DataFrame) -> DataFrame:
    out = kinds[0].select(*COLUMNS)
    for k in kinds[1:]:
        out = out.unionByName(k.select(*COLUMNS))
    return out


def steps(as_of: Column, interval: int) -> Column:
    """How often an alert has gone up a level: once for each whole interval before its recovery, twice at most. One that
    is due at the moment of recovery isn't raised."""
    recover, at = F.col("recover_time"), F.col("alert_time")
    ended = recover.isNotNull() & (recover <= as_of)
    seconds = S.epoch(F.when(ended, recover).otherwise(as_of)) - S.epoch(at) - F.when(ended, 1).otherwise(0)
    return F.least(F.lit(2), F.greatest(F.lit(0), F.floor(seconds / interval))).cast("int")


def escalation_history(alerts: DataFrame, as_of: Column, interval: int = K.ESCALATE_SECONDS) -> DataFrame:
    """A row for each level that an alert takes, with its time as version; a last one, NONE, at its recovery."""
    own = alerts.where(F.col("alert_time") <= as_of).withColumn("_steps", steps(as_of, interval))
    after = lambda s: F.col("alert_time") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (s * interval).cast("decimal(18,6)"))
    row = lambda step, level, at: F.struct(step.alias("step"), level.alias("level"), at.alias("changed"))
    ups = F.transform(F.sequence(F.lit(0), "_steps"), lambda s: row(s, F.get(F.array(*map(F.lit, K.LEVELS[1:])), s), after(s)))
    end = F.when(F.col("recover_time") <= as_of, F.array(row(F.lit(3), F.lit(K.LEVELS[0]), F.col("recover_time")))).otherwise(F.filter(ups, lambda _: F.lit(False)))
    out = own.withColumn("_row", F.explode(F.concat(ups, end))).select(*alerts.columns, "_row.*")
    return out.withColumn("version", S.epoch(F.col("changed")) * 1000)


def current_alerts(history: DataFrame) -> DataFrame:
    """The last state of each alert id."""
    return latest_by_version(history, ["company", "alert_type", "alert_id"], ("version", "step", "alert_time", "productionorder"))


def latest_alerts(alerts: DataFrame, kind: str, n: int = 10) -> DataFrame:
    return alerts.where(F.col("alert_type") == kind).orderBy(F.desc("alert_time"), "alert_id", F.desc("report_quantity")).limit(n)

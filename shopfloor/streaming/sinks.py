"""Idempotent foreachBatch sinks over Parquet, and the streams that write them."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopfloor import constants as K
from shopfloor.functions import scalars as S
from shopfloor.operators.alerts import all_alerts, lag_alerts, over_report_alerts
from shopfloor.operators.minute import minute_rows
from shopfloor.operators.orders import order_achievement
from shopfloor.operators.versions import RECORD, delete_audit, latest_by_version, signed_deltas, sum_merge
from shopfloor.operators.wide import counts, enrich, live_wide
from shopfloor.schemas import MINUTE_KEY, columns
from shopfloor.sources import shared
from shopfloor.sources.changelog import wide_message

Batch = Callable[[DataFrame, int], None]
Dims = dict[str, DataFrame] | Callable[[], dict[str, DataFrame]]


#: Batches after which the state of all records so far is written as one.
COMPACT = 8
#: What the last row of a record has to tell for its minutes.
MINUTES_OF = (*RECORD, "version", "seq", "productionorder", "lotquantity", "is_deleted", "outputdatetime", "company", "workshop", "linecode", "linename", "partcode")
log = logging.getLogger(__name__)


def idempotent_append(df: DataFrame, path: str, batch_id: int, by: tuple[str, ...] = ()) -> dict[str, float]:
    """Rows of one micro-batch, in folders ``by``; a batch that runs again replaces its own. Rows written and
    milliseconds taken."""
    seen, began = Observation(), time.monotonic()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").partitionBy(*by).parquet(f"{path}/batch_id={batch_id}")
    return {"rows": seen.get["rows"], "flush_ms": 1000 * (time.monotonic() - began)}


def written(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def refreshed(load: Callable[[], dict[str, DataFrame]], seconds: float, clock: Callable[[], float] = time.monotonic, kept: tuple[str, ...] = ("orders",)) -> Callable[[], dict[str, DataFrame]]:
    """Dimensions that are loaded again once they are older than ``seconds``, but those ``kept``, which follow their own
    changes; a load that fails keeps the old ones and is logged."""
    held, at = load(), clock()

    def get() -> dict[str, DataFrame]:
        nonlocal held, at
        if clock() - at >= seconds:
            try:
                held = {**load(), **{k: held[k] for k in kept if k in held}}
            except Exception:  # any reader's error: the old copy serves until the next turn
                log.exception("dimensions could not be loaded again")
            at = clock()
        return held

    return get


def write_wide(wide: DataFrame, path: str, batch_id: int, months: bool = False) -> dict[str, float]:
    """A batch of the wide table by shift day, as reports read it, or by month where batches span years; a batch that runs
    again replaces its own. Rows of a folder meet first, so that it has few files; Spark splits a large one."""
    by = "shift_month" if months else "shift_date"
    rows = sink_safe(wide)
    rows = rows.withColumn(by, F.date_format("shift_date", "yyyyMM")) if months else rows
    return idempotent_append(rows.hint("rebalance", by), path, batch_id, (by,))


def alerts_batch(path: str) -> Batch:
    """Alert rows with alert_ms and recover_ms as times, a recovery of 0 as none; replays replace themselves."""

    def run(df: DataFrame, batch_id: int) -> None:
        time_of = lambda c: F.timestamp_millis(F.nullif(c, F.lit(0).cast("bigint")))
        idempotent_append(df.withColumns({"alert_time": time_of("alert_ms"), "recover_time": time_of("recover_ms")}).drop("alert_ms", "recover_ms"), path, batch_id)

    return run


def sink_safe(wide: DataFrame) -> DataFrame:
    """Missing text is '' in the warehouse."""
    return wide.fillna("")


def start(stream: DataFrame, batch: Batch, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Runs over all that is there, or, with ``every``, on a processing-time trigger."""
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def wide_batch(dims: Dims, path: str) -> Batch:
    """Each change as a wide row, and deletions apart for the audit; both partitioned by batch. ``dims`` may be what
    ``refreshed`` gives."""

    def run(df: DataFrame, batch_id: int) -> None:
        idempotent_append(delete_audit(made_wide(df, dims, path, batch_id)), f"{path}/audit", batch_id)

    return run


def minute_deltas_batch(dims: Dims, path: str, late: tuple[int, int] | None = None) -> Batch:
    """Signed deltas of the batch's records, from their last rows before it and their new ones.

    Deltas add up whatever batch they come in, so none is dropped for being late. The state is the last row of each record:
    each batch writes those of its own records, and every COMPACT batches all. It is read from the last such batch on and
    before this one, so a batch reads a bounded number of them, and one that runs again finds the same state.

    With ``late``, the seconds of disorder and of lateness allowed, deltas of minutes that were over by then, on the clock
    of the batches before, are written beside the others with late_flag; ``late_rows`` counts them.
    """

    def run(df: DataFrame, batch_id: int) -> None:
        new = made_wide(df, dims, path, batch_id, MINUTES_OF)
        wide = new.withColumn("_new", F.lit(True))
        if batch_id:
            held = state_before(df.sparkSession, f"{path}/state", batch_id).join(new.select(*RECORD).distinct(), RECORD, "left_semi")
            wide = wide.unionByName(latest_by_version(held, RECORD).withColumn("_new", F.lit(False)))
        known = new.select(*RECORD, "version", "seq")
        deltas = signed_deltas(wide.drop("_new"), counts(wide) & ~F.col("is_deleted"), RECORD, ["outputdatetime", "company", "workshop", "linecode", "linename", "partcode"])
        deltas = deltas.join(known, [*RECORD, "version", "seq"], "left_semi")
        rows = minute_rows(deltas).select(*MINUTE_KEY, "linename", "output_quantity", "record_cnt")
        if late is None:
            idempotent_append(rows, f"{path}/minutes", batch_id)
        else:
            over = late_since(df.sparkSession, f"{path}/clock", batch_id, *late)
            idempotent_append(rows.withColumn("late_flag", F.coalesce(F.col("ts_minute") + F.expr("interval 1 minute") <= over, F.lit(False))), f"{path}/minutes", batch_id, ("late_flag",))
            keep_clock(new, f"{path}/clock", batch_id)
        keep_state(wide.drop("_new"), f"{path}/state", batch_id)
        shared.remove(df.sparkSession, f"{path}/wide")

    return run


def clock_before(spark, path: str, batch_id: int):
    """The greatest event time of all batches before one, which the last of them wrote; None before the first."""
    return spark.read.parquet(f"{path}/batch_id={batch_id - 1}").first()["seen"] if batch_id else None


def keep_clock(rows: DataFrame, path: str, batch_id: int) -> None:
    """Writes the greatest event time up to and with a batch; one that runs again writes the same."""
    before = F.lit(clock_before(rows.sparkSession, path, batch_id)).cast("timestamp_ntz")
    idempotent_append(rows.agg(F.greatest(F.max("outputdatetime"), before).alias("seen")), path, batch_id)


def late_since(spark, path: str, batch_id: int, disorder: int, allowed: int) -> Column:
    """The time whose minutes, once over by then, are late in a batch; null in the first."""
    return F.lit(clock_before(spark, path, batch_id)).cast("timestamp_ntz") - F.expr(f"interval {disorder + allowed} seconds")


def late_rows(spark, path: str) -> DataFrame:
    """Late and other deltas by batch."""
    return spark.read.parquet(f"{path}/minutes").groupBy("batch_id").agg(F.count_if(F.col("late_flag").cast("boolean")).alias("late"), F.count_if(~F.col("late_flag").cast("boolean")).alias("in_time"))


def made_wide(df: DataFrame, dims: Dims, path: str, batch_id: int, names: tuple[str, ...] = ("*",)) -> DataFrame:
    """The batch's wide rows, or columns of them, as a stored table, joined once for all that reads them."""
    idempotent_append(enrich(df, dims() if callable(dims) else dims).select(*names), f"{path}/wide", batch_id)
    return df.sparkSession.read.parquet(f"{path}/wide/batch_id={batch_id}")


def keep_state(own: DataFrame, path: str, batch_id: int) -> None:
    """Writes the last rows of a batch's own records; every COMPACT batches those of all records so far."""
    if batch_id and batch_id % COMPACT == 0:
        own = own.unionByName(state_before(own.sparkSession, path, batch_id))
    idempotent_append(latest_by_version(own, RECORD), path, batch_id)


def state_before(spark, path: str, batch_id: int) -> DataFrame:
    """The rows of all records before a batch, from the last whole state on; a record may have several."""
    first = (batch_id - 1) // COMPACT * COMPACT
    rows = spark.read.parquet(path).where((F.col("batch_id") >= first) & (F.col("batch_id") < batch_id))
    return rows.drop("batch_id")


def rows_batch(path: str, name: str = "rows") -> Batch:
    """Rows of a keyed stream as they come; a batch that runs again replaces its own."""

    def run(df: DataFrame, batch_id: int) -> None:
        idempotent_append(df, f"{path}/{name}", batch_id)

    return run


def late_minutes(spark, path: str) -> DataFrame:
    """Minutes of deltas in time, and of late ones, apart; together they are ``minutes``."""
    rows = written(spark, f"{path}/minutes").withColumn("late_flag", F.col("late_flag").cast("boolean"))
    return sum_merge(rows, [*MINUTE_KEY, "late_flag"], ["output_quantity", "record_cnt"], ("linename",), drop_zero=True)


#: What a message of a file log has.
LOG = columns("id string, version long, seq long, key string, value string, sent timestamp")


def log_batch(path: str, encode: Callable[[DataFrame], DataFrame]) -> Batch:
    """Messages of a batch at the end of a log of packed JSON lines, with the time at which they are sent. A batch that runs again
    is in the log again: ``read_log`` gives it once. ``encode`` makes id, version, seq, key and value."""

    def run(df: DataFrame, batch_id: int) -> None:
        encode(df).withColumn("sent", F.current_timestamp()).select(*LOG.fieldNames()).write.mode("append").option("compression", "gzip").json(path)

    return run


def read_log(spark, path: str, within: str = "1 hour") -> DataFrame:
    """The messages of a log as a stream, each (id, version, seq) once, if it is sent again within that time.

    The clock is the log's own, the time of sending, so rows that report old events are no late ones; state goes once the
    log is ``within`` past them.
    """
    lines = spark.readStream.schema(LOG).json(path)
    return lines.withWatermark("sent", within).dropDuplicatesWithinWatermark(["id", "version", "seq"])


def wide_messages(wide: DataFrame) -> DataFrame:
    """The wide topic's messages with what tells a change from all others."""
    names = [c for c in wide.columns if c not in ("db_name", "tbl_name", "op", "seq")]
    return wide.select(F.concat_ws(":", *RECORD).alias("id"), "version", F.col("seq").cast("bigint").alias("seq"), *[c.alias(n) for n, c in wide_message(names).items()])


def minutes(spark, path: str) -> DataFrame:
    return sum_merge(written(spark, f"{path}/minutes"), MINUTE_KEY, ["output_quantity", "record_cnt"], ("linename",), drop_zero=True)


def orders_batch(dims: Dims, path: str, now: Column) -> Batch:
    """Achievement of the orders that the batch touches, those that its records leave included; the batch is the version.

    The state is that of ``minute_deltas_batch``: a batch reads the last rows of records, not all of their versions, and
    joins them to its own orders before anything is sorted.
    """
    key = ["db_name", "productionorderid"]

    def run(df: DataFrame, batch_id: int) -> None:
        known = dims() if callable(dims) else dims
        rows = new = made_wide(df, known, path, batch_id)
        idempotent_append(delete_audit(new), f"{path}/audit", batch_id)
        touched = new.select(*key)
        if batch_id:
            state = state_before(df.sparkSession, f"{path}/state", batch_id)
            touched = touched.unionByName(state.join(new.select(*RECORD).distinct(), RECORD, "left_semi").select(*key))
            # a record's last row may be in another order than an older one
            near = state.join(touched, key, "left_semi").select(*RECORD).unionByName(new.select(*RECORD)).distinct()
            rows = new.unionByName(state.join(near, RECORD, "left_semi"))
        touched = touched.distinct()
        live = live_wide(rows).join(touched, key, "left_semi")
        made = order_achievement(live, now, "order").withColumns({"version": F.lit(batch_id).cast("bigint"), "seq": F.lit(0)})
        # an order without live rows left is written as gone
        gone = touched.withColumns({"company": S.company(F.col("db_name")), "datasource": S.datasource(F.col("db_name"))}).join(known["orders"].select("db_name", "productionorderid", F.col("productionorderno").alias("productionorder")), key)
        gone = gone.join(made, ["company", "datasource", "productionorder"], "left_anti").select("company", "datasource", "productionorder", F.lit(batch_id).cast("bigint").alias("version"), F.lit(0).alias("seq"))
        idempotent_append(made.unionByName(gone, allowMissingColumns=True), f"{path}/orders", batch_id)
        keep_state(new, f"{path}/state", batch_id)
        shared.remove(df.sparkSession, f"{path}/wide")

    return run


def achievements(spark, path: str) -> DataFrame:
    last = latest_by_version(written(spark, f"{path}/orders"), ["company", "datasource", "productionorder"])
    return last.where("report_quantity is not null").drop("version", "seq")


def alerts_of(wide: DataFrame) -> DataFrame:
    live = live_wide(wide)
    return all_alerts(over_report_alerts(live), lag_alerts(live))


def windowed_minutes(deltas: DataFrame) -> DataFrame:
    """Minute sums by event-time window with a watermark of the disorder and the lateness allowed, each emitted once;
    ``event_time`` must be a timestamp with a zone."""
    late = K.WATERMARK_SECONDS + K.LATENESS_SECONDS
    held = deltas.withWatermark("event_time", f"{late} seconds")
    out = held.groupBy(F.window("event_time", "1 minute"), "company", "workshop", "linecode", "partcode").agg(F.sum("qty_delta").alias("output_quantity"), F.sum("cnt_delta").alias("record_cnt"))
    return out.select(F.col("window.start").alias("ts_minute"), "company", "workshop", "linecode", "partcode", "output_quantity", "record_cnt")

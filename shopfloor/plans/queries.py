"""Queries by name over the derived inputs; quantities leave as doubles."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopfloor.functions import scalars as S
from shopfloor.operators import alerts as A
from shopfloor.operators import digest, minute, orders, profile, reconcile, versions, wide
from shopfloor.operators.versions import RECORD
from shopfloor.schemas import ORDER, REPORT
from shopfloor.sources import changelog, fixtures, shared
from shopfloor.streaming import jobs, metrics, sinks, timers

IDLE, STEP = 30 * 86400, 10 * 86400  # these inputs span years
PARTS = 3
#: Reports' changes from which on a log is large, and how many slices it is joined in.
LARGE, SLICES = 10_000_000, 4

Query = Callable[[SparkSession, str], DataFrame]


def now() -> Column:
    """The moment at which all queries look."""
    return F.lit("1996-06-01 00:00:00").cast("timestamp_ntz")


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, integers as bigint."""
    kinds = {"decimal": "double", "int": "bigint"}
    return df.select([F.col(c).cast(kinds[k.split("(")[0]]).alias(c) if k.split("(")[0] in kinds else F.col(c) for c, k in df.dtypes])


class Inputs:
    """The derived inputs of one run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.log = fixtures.log(spark, sf_dir)
        self.dims = fixtures.dims(spark, sf_dir)

    @cached_property
    def held(self) -> dict[str, DataFrame]:
        """The dimensions for streams, whose every batch reads them: orders, which take joins to make, as a table."""
        return {**self.dims, "orders": shared.stored(self.dims["orders"], "orders")}

    @cached_property
    def large(self) -> bool:
        """Whether the shuffles of a whole query are too much to lie on disk at once."""
        return fixtures.table(self.spark, self.sf_dir, "lineitem").count() >= LARGE

    @cached_property
    def steps(self) -> DataFrame:
        """A large log as a table, of which the shuffles are gone."""
        return shared.stored(self.log, "log")

    def made(self, make: Callable[[DataFrame, dict[str, DataFrame]], DataFrame]) -> DataFrame:
        """What ``make`` gives of the log and the dimensions, record by record; a large log goes through in slices."""
        if not self.large:
            return make(self.log, self.dims)
        return shared.in_slices(self.steps, RECORD, lambda rows: make(rows, self.held), "made", SLICES)

    @property
    def wide(self) -> DataFrame:
        return self.made(wide.enrich)

    @property
    def live(self) -> DataFrame:
        return self.made(wide.live_of)

    @property
    def deltas(self) -> DataFrame:
        def deltas(log: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
            rows = wide.enrich(log, dims)
            return versions.signed_deltas(rows, wide.counts(rows) & ~F.col("is_deleted"), RECORD, minute.CARRIED)

        return self.made(deltas)

    @property
    def alerts(self) -> DataFrame:
        live = self.live
        return A.all_alerts(A.over_report_alerts(live), A.lag_alerts(live), A.missing_report_alerts(live, now(), IDLE))

    @property
    def history(self) -> DataFrame:
        return A.escalation_history(self.alerts, now(), STEP)


QUERIES: dict[str, Query] = {}


def query(f: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: plain(f(Inputs(spark, sf_dir)))
    return f


@query
def shift_days(i: Inputs) -> DataFrame:
    day = S.shift_date(F.col("event_time"))
    return i.log.select("record_id", "version", day.alias("shift_date"), S.shift_epoch_day(F.col("event_time")).alias("epoch_day"), S.shift_start(day).alias("shift_start"), S.shift_end(day).alias("shift_end"), S.minute_floor(F.col("event_time")).alias("ts_minute"), S.partition_day(F.col("event_time")).alias("day"))


@query
def site_parse(i: Inputs) -> DataFrame:
    return changelog.with_site(i.log.select("db_name")).groupBy("db_name", "company", "datasource").agg(F.count("*").alias("changes"))


@query
def unify_reports(i: Inputs) -> DataFrame:
    return changelog.unify_reports(fixtures.lots(i.log), fixtures.scans(i.log))


@query
def multi_database(i: Inputs) -> DataFrame:
    return changelog.databases(fixtures.scans(i.log), "mes_old_.*").groupBy("db_name", "tbl_name").agg(F.count("*").alias("changes"), F.sum("quantity").alias("qty"))


@query
def snapshot_changes(i: Inputs) -> DataFrame:
    rows = changelog.snapshot_then_changes(i.log.where("op = 'c'").drop("version"), i.log.where("op <> 'c'"))
    return rows.groupBy("db_name", "version").agg(F.count("*").alias("records"), F.sum("qty").alias("qty"))


@query
def route_envelope(i: Inputs) -> DataFrame:
    routed = changelog.route_envelope(fixtures.envelopes(i.log))
    return changelog.flatten(routed).select("op", "record_id", "db_name", "finishedquantity", "createddate", F.col("version").alias("version_ms"))


@query
def json_roundtrip(i: Inputs) -> DataFrame:
    sent = changelog.encode_changelog(fixtures.envelopes(i.log), ["record_id", "version"])
    back = changelog.flatten(changelog.route_envelope(changelog.parse_envelopes(sent, REPORT)))
    return back.select("op", "record_id", "db_name", "finishedquantity", "createddate", F.col("version").alias("version_ms"))


def sent_orders(i: Inputs) -> DataFrame:
    """Order changes as they come back from JSON."""
    return changelog.order_changes(changelog.parse_envelopes(fixtures.sent_orders(fixtures.order_history(i.dims["orders"])), ORDER))


@query
def order_changelog(i: Inputs) -> DataFrame:
    return sent_orders(i).where("reason is null").drop("reason", "op_ts").withColumnRenamed("version", "version_ms")


@query
def current_orders(i: Inputs) -> DataFrame:
    return changelog.current_orders(sent_orders(i))


@query
def order_topic(i: Inputs) -> DataFrame:
    sent = changelog.encode_orders(changelog.ods_orders(sent_orders(i)))
    back = changelog.flatten(changelog.route_envelope(changelog.parse_envelopes(sent, ORDER).withColumn("seq", F.lit(0))))
    keyed = sent.groupBy("key").agg(F.count("*").alias("messages"))
    return keyed.join(back.select(F.to_json(F.struct(S.company(F.col("db_name")).alias("company"), S.datasource(F.col("db_name")).alias("datasource"), "productionorderid")).alias("key"), "orderquantity").groupBy("key").agg(F.max("orderquantity").alias("orderquantity")), "key")


@query
def raw_to_live(i: Inputs) -> DataFrame:
    """From JSON envelopes of reports to live wide rows."""
    read = changelog.flatten(changelog.route_envelope(changelog.parse_envelopes(fixtures.sent_reports(i.log), REPORT)))
    good, _ = changelog.split_dirty(read)
    return wide.live_of(changelog.to_changes(good), i.dims).drop("tbl_name", "op", "seq")


@query
def wide_roundtrip(i: Inputs) -> DataFrame:
    sent = changelog.encode_wide(i.wide.select("record_id", "version", "company", "productionorder", "lotquantity", "shift_date", "is_deleted"))
    good, _ = changelog.parse_wide(sent)
    return good.groupBy("company", "shift_date", "is_deleted").agg(F.count("*").alias("records"), F.sum("lotquantity").alias("qty"))


@query
def dirty_split(i: Inputs) -> DataFrame:
    key = F.col("record_id").cast("bigint")
    rows = fixtures.lots(i.log).withColumns({"op": F.when(key % 97 == 1, "t").otherwise(F.col("op")), "db_name": F.when(key % 89 == 2, None).otherwise(F.col("db_name")), "tbl_name": F.when(key % 83 == 3, "stock").otherwise(F.col("tbl_name")), "createddate": F.when(key % 79 == 4, None).otherwise(F.col("createddate")), "scantime": F.lit(None).cast("timestamp_ntz")})
    good, bad = changelog.split_dirty(rows)
    return good.groupBy().agg(F.lit("ok").alias("reason"), F.count("*").alias("records")).unionByName(bad.groupBy("reason").agg(F.count("*").alias("records")))


@query
def latest_reports(i: Inputs) -> DataFrame:
    return versions.latest_by_version(i.log, RECORD).select(*RECORD, "op", "version", "qty", "event_time")


@query
def live_wide(i: Inputs) -> DataFrame:
    return i.live.drop("tbl_name", "op", "seq")


@query
def live_filter_first(i: Inputs) -> DataFrame:
    return wide.live_wide(i.wide, "filter_first").groupBy("company", "outputtype").agg(F.count("*").alias("records"), F.sum("lotquantity").alias("qty"))


@query
def asof_order_join(i: Inputs) -> DataFrame:
    """Orders that change at version 2, when their quantity doubles, and go at version 4 if their number ends on 7."""
    history = fixtures.order_history(i.dims["orders"]).select("db_name", "productionorderid", "productionorderno", "orderquantity", "version", "op")
    met = wide.asof_order_join(i.log.select("db_name", "productionorderid", "record_id", "version"), history)
    return met.select("record_id", "version", F.col("order.productionorderno").alias("productionorderno"), F.col("order.orderquantity").alias("orderquantity"))


@query
def dim_miss_profile(i: Inputs) -> DataFrame:
    return wide.dim_miss_profile(i.live)


@query
def dim_miss_rows(i: Inputs) -> DataFrame:
    met = i.log.join(i.dims["orders"].select("db_name", "productionorderid", "partid"), ["db_name", "productionorderid"])
    return wide.dim_miss_rows(met, i.dims["parts"], ["db_name", "partid"]).select("db_name", "record_id", "version", "partid")


@query
def delete_audit(i: Inputs) -> DataFrame:
    return versions.delete_audit(i.wide.select("record_id", "company", "op", "tbl_name", "version", "productionorder"), now())


@query
def signed_deltas(i: Inputs) -> DataFrame:
    return i.deltas.select("record_id", "version", "qty_delta", "cnt_delta", "linecode", "outputdatetime")


@query
def minute_output(i: Inputs) -> DataFrame:
    return minute.minute_output(i.deltas)


@query
def minute_salted(i: Inputs) -> DataFrame:
    return minute.minute_salted(i.deltas).where("output_quantity <> 0 or record_cnt <> 0")


@query
def minute_merge(i: Inputs) -> DataFrame:
    rows = i.deltas
    parts = [minute.minute_output(rows.where(c), drop_zero=False) for c in ("version = 1", "version > 1")]
    return versions.sum_merge(parts[0].unionByName(parts[1]), ["ts_minute", "company", "workshop", "linecode", "partcode"], minute.SUMS, ("linename",), drop_zero=True)


@query
def recompute_minute(i: Inputs) -> DataFrame:
    return minute.recompute_minute(i.live)


@query
def order_achievement(i: Inputs) -> DataFrame:
    return orders.order_achievement(i.live, now()).select(*orders.GRAINS["order_shift"], "report_quantity", "order_quantity", "achieve_rate", "last_report_time")


@query
def plan_progress(i: Inputs) -> DataFrame:
    return orders.order_achievement(i.live, now(), "order").select(*orders.GRAINS["order"], "achieve_rate", "plan_progress", "finished", "progress_deviation")


@query
def dim_achievement(i: Inputs) -> DataFrame:
    return orders.dim_achievement(orders.order_achievement(i.live, now()))


@query
def recompute_orders(i: Inputs) -> DataFrame:
    return orders.recompute_orders(i.live, now())


@query
def recon_site_shift(i: Inputs) -> DataFrame:
    return reconcile.recon_site_shift(reconcile.between(i.live, "1993-01-01", "1997-01-01"))


@query
def recon_workshop_line(i: Inputs) -> DataFrame:
    return reconcile.recon_workshop_line(i.live)


@query
def recon_order(i: Inputs) -> DataFrame:
    return reconcile.recon_order(i.live)


@query
def version_audit(i: Inputs) -> DataFrame:
    return versions.version_audit(i.log)


@query
def baseline_manual_shift(i: Inputs) -> DataFrame:
    return reconcile.baseline_manual_shift(fixtures.lots(last_rows(i)), i.dims["orders"])


@query
def baseline_lpn_shift(i: Inputs) -> DataFrame:
    return reconcile.baseline_lpn_shift(fixtures.scans(last_rows(i)), i.dims["orders"])


@query
def baseline_workshop_line(i: Inputs) -> DataFrame:
    return reconcile.baseline_workshop_line(fixtures.lots(last_rows(i)), i.dims["orders"], i.dims["workcenters"], i.dims["worksites"])


@query
def baseline_order_rate(i: Inputs) -> DataFrame:
    return reconcile.baseline_order_rate(fixtures.lots(last_rows(i)), i.dims["orders"])


def last_rows(i: Inputs) -> DataFrame:
    """The source tables as they stand after all changes."""
    return versions.latest_by_version(i.log, RECORD).where("op <> 'd'")


@query
def reconcile_site_shift(i: Inputs) -> DataFrame:
    base = changelog.with_site(reconcile.baseline_manual_shift(fixtures.lots(last_rows(i)), i.dims["orders"])).groupBy("company", "shift_date").agg(F.sum("report_qty").alias("report_qty"))
    result = reconcile.totals(i.live.where("outputtype = 'MANUAL'"), ["company", "shift_date"])
    return reconcile.reconcile(base, result, ["company", "shift_date"])


@query
def reconcile_workshop_line(i: Inputs) -> DataFrame:
    keys = ["company", "workshop", "linecode"]
    base = changelog.with_site(reconcile.baseline_workshop_line(fixtures.lots(last_rows(i)), i.dims["orders"], i.dims["workcenters"], i.dims["worksites"])).groupBy(*keys).agg(F.sum("report_qty").alias("report_qty"))
    return reconcile.reconcile(base, reconcile.totals(i.live.where("outputtype = 'MANUAL'"), keys), keys)


@query
def reconcile_order(i: Inputs) -> DataFrame:
    keys = ["company", "datasource", "productionorder"]
    base = changelog.with_site(reconcile.baseline_order_rate(fixtures.lots(last_rows(i)), i.dims["orders"])).groupBy(*keys).agg(F.sum("report_qty").alias("report_qty"))
    return reconcile.reconcile(base, reconcile.totals(i.live.where("outputtype = 'MANUAL'"), keys), keys)


@query
def reconcile_scan_shift(i: Inputs) -> DataFrame:
    keys = ["company", "shift_date"]
    base = changelog.with_site(reconcile.baseline_lpn_shift(fixtures.scans(last_rows(i)), i.dims["orders"])).groupBy(*keys).agg(F.sum("report_qty").alias("report_qty"))
    return reconcile.reconcile(base, reconcile.totals(i.live.where("outputtype = 'BARCODE'"), keys), keys)


@query
def reconcile_scan_packages(i: Inputs) -> DataFrame:
    """The packages behind the shift days that differ: scans count on their own day, packages on that of the last scan."""
    levels, record = ["company", "shift_date", "productionorder"], ["lpnbarcode"]
    base = changelog.with_site(reconcile.package_scans(fixtures.scans(last_rows(i)), i.dims["orders"]))
    result = i.live.where("outputtype = 'BARCODE'").groupBy(*levels, *record).agg(F.sum("lotquantity").alias("qty"))
    return reconcile.differing_records(base, result, levels, record)


def compared_records(i: Inputs) -> tuple[DataFrame, DataFrame, list[str], list[str]]:
    """The manual source as it stands, and the rows that are left if those that don't count go before versions are chosen."""
    rows = reconcile.with_orders(fixtures.lots(last_rows(i)).where("finishedquantity > 0"), i.dims["orders"]).join(i.dims["workcenters"], ["db_name", "workcenterid"], "left")
    base = changelog.with_site(rows).withColumnsRenamed({"productionorderno": "productionorder", "finishedquantity": "qty"})
    result = wide.live_wide(i.wide, "filter_first").where("outputtype = 'MANUAL'").withColumnRenamed("lotquantity", "qty")
    return base, result, ["company", "linecode", "productionorder"], ["record_id"]


@query
def reconcile_records(i: Inputs) -> DataFrame:
    return reconcile.differing_records(*compared_records(i))


@query
def reconcile_tree(i: Inputs) -> DataFrame:
    return reconcile.difference_tree(*compared_records(i))


@query
def ordered_workshop_line(i: Inputs) -> DataFrame:
    return reconcile.ordered(reconcile.recon_workshop_line(i.live), "workshop_line")


@query
def ordered_orders(i: Inputs) -> DataFrame:
    return reconcile.ordered(reconcile.recon_order(i.live, with_datasource=False), "order")


@query
def alert_counters(i: Inputs) -> DataFrame:
    return profile.alert_counters(A.escalation_history(A.missing_report_alerts(i.live, now(), IDLE), now(), STEP))


@query
def total_check(i: Inputs) -> DataFrame:
    return reconcile.total_check(minute.minute_output(i.deltas), i.live)


@query
def order_running_qty(i: Inputs) -> DataFrame:
    return orders.order_running_qty(i.live).select("record_id", "shift_date", "productionorder", "running_qty")


@query
def order_running_blocks(i: Inputs) -> DataFrame:
    return orders.running_in_blocks(i.live).select("record_id", "shift_date", "productionorder", "running_qty")


@query
def over_report_alerts(i: Inputs) -> DataFrame:
    return A.over_report_alerts(i.live, grain="order")


@query
def lag_alerts(i: Inputs) -> DataFrame:
    return A.lag_alerts(i.live, grain="order")


@query
def missing_report_alerts(i: Inputs) -> DataFrame:
    return A.missing_report_alerts(i.live, now(), IDLE).select("alert_id", "company", "linecode", "alert_time", "recover_time")


@query
def escalation_history(i: Inputs) -> DataFrame:
    return A.escalation_history(A.missing_report_alerts(i.live, now(), IDLE), now(), STEP).select("alert_id", "alert_time", "step", "level", "changed", "version")


@query
def current_alerts(i: Inputs) -> DataFrame:
    return A.current_alerts(A.escalation_history(A.missing_report_alerts(i.live, now(), IDLE), now(), STEP)).select("alert_type", "alert_id", "level", "changed", "alert_time")


@query
def alert_totals(i: Inputs) -> DataFrame:
    return i.alerts.groupBy("alert_type", "company").agg(F.count("*").alias("alerts"), F.count("recover_time").alias("recovered"))


@query
def latest_alerts(i: Inputs) -> DataFrame:
    return A.latest_alerts(A.over_report_alerts(i.live), "OVER_REPORT", 10).select("alert_id", "alert_time", "report_quantity")


def month(column: str):
    return F.date_trunc("month", F.col(column)).cast("timestamp_ntz")


def digests(i: Inputs) -> DataFrame:
    raised = A.escalation_history(A.missing_report_alerts(i.live, now(), IDLE), now(), STEP).where("level <> 'NONE'")
    return digest.alert_digest(raised, F.date_trunc("day", F.col("changed")).cast("timestamp_ntz"))


@query
def alert_digest(i: Inputs) -> DataFrame:
    return digests(i)


@query
def digest_rate_limit(i: Inputs) -> DataFrame:
    return digest.rate_limit(digests(i), month("flush")).select("bucket", "flush", "company", "alert_type", "sent")


@query
def alert_messages(i: Inputs) -> DataFrame:
    sent = changelog.encode_alert(A.missing_report_alerts(i.live, now(), IDLE).select("alert_id", "company", "linecode", "productionorder"))
    return sent.groupBy("key").agg(F.count("*").alias("messages"))


@query
def quality_profile(i: Inputs) -> DataFrame:
    return profile.quality_profile(i.wide)


@query
def day_shift_share(i: Inputs) -> DataFrame:
    return i.live.groupBy("company").agg(F.count("*").alias("records"), F.count_if(S.is_day_shift(F.col("outputdatetime"))).alias("day_records"))


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: Batches without rows move the event clock on; on the machine's clock they would never end.
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
Made = tuple[DataFrame, sinks.Batch]


@contextmanager
def stores(spark: SparkSession, clock: bool) -> Iterator[None]:
    """Within this, streams keep state in RocksDB, and have batches without rows only on the event clock. Shuffle files of
    a write go when it ends; else those of all batches would stay while the stream runs."""
    before = {name: spark.conf.get(name) for name in (PROVIDER, NO_DATA, shared.CLEAN)}
    spark.conf.set(PROVIDER, ROCKSDB)
    spark.conf.set(NO_DATA, str(clock).lower())
    spark.conf.set(shared.CLEAN, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def streamed(i: Inputs, make: Callable[[dict[str, DataFrame], str], Made], clock: bool = False, watch: Callable[[str], metrics.Metrics] | None = None, lines: bool = False, **inputs: tuple[DataFrame, Column]) -> str:
    """Runs inputs, each with the number of its part of PARTS, through the stream and sink that ``make`` gives, a part
    after another over one checkpoint; the sink's folder. The changelog, by version, is the input if none is given.
    ``watch`` gives a listener to the stream's figures. Inputs that are ``lines`` have reports' envelopes, with seq, as
    value, and reach the stream through text files. Inputs are made once, dealt into folders by part, and a part's files
    go once the stream has taken them."""
    spark = i.spark
    path = shared.folder(spark, "stream")
    inputs = inputs or {"log": (i.log, F.least(F.col("version"), F.lit(PARTS)))}
    seen = watch(path) if watch else None
    if seen:
        spark.streams.addListener(seen)
    try:
        with stores(spark, clock):
            for name, (rows, part) in inputs.items():
                deal(rows, part, f"{path}/in/{name}", lines)
            for k in range(1, PARTS + 1):
                at = lambda name: f"{path}/in/{name}/part_no=[1-{k}]"  # noqa: B023, E731
                read = lambda name, rows: changelog.read_changelog(spark, at(name), REPORT, True, True) if lines else spark.readStream.schema(rows.schema).parquet(at(name))  # noqa: B023, E731
                streams = {name: read(name, rows) for name, (rows, _) in inputs.items()}
                out, batch = make(streams, path)
                running = sinks.start(out, batch, f"{path}/checkpoint")
                running.awaitTermination()
                if seen and not seen.settled(running):
                    raise RuntimeError("the events of a stream did not come")
                for name in inputs:
                    shared.remove(spark, f"{path}/in/{name}/part_no={k}")
    finally:
        if seen:
            spark.streams.removeListener(seen)
    return path


def deal(rows: DataFrame, part: Column, path: str, lines: bool) -> None:
    """Rows in a folder for each of PARTS parts, each with one file at least, so that a part without rows is a batch too."""
    kind, packed = ("text", {"compression": "gzip"}) if lines else ("parquet", {})
    names = ["value"] if lines else rows.columns
    rows.select(*names, part.alias("part_no")).write.partitionBy("part_no").format(kind).options(**packed).save(path)
    for k in range(1, PARTS + 1):
        rows.limit(0).select(*names).write.mode("append").format(kind).options(**packed).save(f"{path}/part_no={k}")


def by_batch(batch: Callable[[str], sinks.Batch]) -> Callable[[dict[str, DataFrame], str], Made]:
    """A sink that takes the changelog itself."""
    return lambda s, path: (s["log"], batch(path))


@query
def stream_minute_keyed(i: Inputs) -> DataFrame:
    """From the keyed state of records alone."""
    return sinks.minutes(i.spark, streamed(i, lambda s, path: (timers.minute_deltas(wide.enrich(s["log"], i.held)), sinks.rows_batch(path, "minutes"))))


@query
def stream_minute_deltas(i: Inputs) -> DataFrame:
    """From the last rows of records that batches keep."""
    return sinks.minutes(i.spark, streamed(i, by_batch(lambda p: sinks.minute_deltas_batch(i.held, p))))


@query
def stream_live_wide(i: Inputs) -> DataFrame:
    path = streamed(i, by_batch(lambda p: sinks.wide_batch(i.held, p)))
    return wide.live_wide(sinks.written(i.spark, f"{path}/wide")).drop("tbl_name", "op", "seq")


@query
def stream_orders(i: Inputs) -> DataFrame:
    path = streamed(i, by_batch(lambda p: sinks.orders_batch(lambda: i.held, p, now())))
    return sinks.achievements(i.spark, path).select(*orders.GRAINS["order"], "achieve_rate", "plan_progress", "finished", "progress_deviation")


@query
def stream_alerts(i: Inputs) -> DataFrame:
    path = streamed(i, by_batch(lambda p: sinks.wide_batch(i.held, p)))
    return sinks.alerts_of(sinks.written(i.spark, f"{path}/wide")).groupBy("alert_type", "company").agg(F.count("*").alias("alerts"), F.count("recover_time").alias("recovered"))


@query
def stream_delete_audit(i: Inputs) -> DataFrame:
    """The audit that the streams write beside their rows."""
    path = streamed(i, by_batch(lambda p: sinks.wide_batch(i.held, p)))
    return sinks.written(i.spark, f"{path}/audit").select("record_id", "company", "table_name", "ts_ms")


@query
def stream_asof_orders(i: Inputs) -> DataFrame:
    """Reports and order changes as one stream, with the orders' versions in keyed state."""
    history = fixtures.order_history(i.dims["orders"]).select("db_name", "productionorderid", "productionorderno", "orderquantity", "version", "op")
    reports = i.log.select("db_name", "productionorderid", "record_id", "version")
    part = F.least(F.col("version"), F.lit(PARTS))
    path = streamed(i, lambda s, path: (timers.orders_as_of(s["reports"], s["changes"]), sinks.rows_batch(path)), reports=(reports, part), changes=(history, part))
    return sinks.written(i.spark, path + "/rows").select("record_id", "version", "productionorderno", "orderquantity")


#: Seconds of disorder and of lateness allowed, for inputs that span years.
LATE = 60 * 86400, 300 * 86400


@query
def stream_late_minutes(i: Inputs) -> DataFrame:
    """Minutes of deltas in time and of late ones, apart."""
    return sinks.late_minutes(i.spark, streamed(i, by_batch(lambda p: sinks.minute_deltas_batch(i.held, p, LATE))))


@query
def stream_late_counts(i: Inputs) -> DataFrame:
    """Late and other deltas by batch."""
    return sinks.late_rows(i.spark, streamed(i, by_batch(lambda p: sinks.minute_deltas_batch(i.held, p, LATE))))


@query
def stream_replayed_log(i: Inputs) -> DataFrame:
    """The wide topic as a file log that has every batch twice, read once, by key."""

    def make(s: dict[str, DataFrame], path: str) -> Made:
        send = sinks.log_batch(f"{path}/log", sinks.wide_messages)

        def twice(df: DataFrame, batch_id: int) -> None:
            send(df, batch_id)
            send(df, batch_id)

        return wide.enrich(s["log"], i.held), twice

    path = streamed(i, make)
    with stores(i.spark, False):
        sinks.start(sinks.read_log(i.spark, f"{path}/log"), sinks.rows_batch(path, "once"), f"{path}/read").awaitTermination()
    once = sinks.written(i.spark, f"{path}/once")
    good, _ = changelog.parse_wide(once)
    keyed = good.withColumn("key", F.coalesce(F.nullif("productionorder", F.lit("")), "record_id")).groupBy("key").agg(F.sum("lotquantity").alias("qty"))
    return once.groupBy("key").agg(F.count("*").alias("messages"), F.countDistinct("id").alias("records")).join(keyed, "key")


@query
def stream_metrics(i: Inputs) -> DataFrame:
    """The counters that the listener gathers from a stream of changes and one of alerts."""
    made: list[str] = []
    watch = lambda path: made.append(path) or metrics.Metrics(i.spark, f"{path}/metrics")
    streamed(i, lambda s, path: (metrics.observed_changes(wide.enrich(s["log"], i.held)), sinks.rows_batch(path, "wide")), watch=watch)
    alerts = i.history.select("alert_id", "alert_type", "level", "step", "changed")
    streamed(i, lambda s, path: (metrics.observed_alerts(s["alerts"]), sinks.rows_batch(path, "alerts")), watch=watch, alerts=(alerts, F.least(F.col("step") + 1, F.lit(PARTS))))
    one = metrics.read(i.spark, f"{made[0]}/metrics").unionByName(metrics.read(i.spark, f"{made[1]}/metrics"))
    return metrics.totals(one)


def on_the_clock(i: Inputs, rows: DataFrame, end: Column, make: Callable[[DataFrame], DataFrame], sink: Callable[[str], sinks.Batch] = lambda path: sinks.alerts_batch(path + "/alerts")) -> DataFrame:
    """The alert table of a stream over rows on the event clock, in parts by time, with the clock set to ``end`` last."""
    day = F.lit("1994-01-01").cast("timestamp_ntz"), F.lit("1995-06-01").cast("timestamp_ntz")
    part = F.coalesce(F.when(F.col("event_ms") < timers.millis(day[0]), 1).when(F.col("event_ms") < timers.millis(day[1]), 2), F.lit(PARTS))
    clock = rows.limit(0).unionByName(i.spark.range(1).select((timers.millis(end) + 500).alias("event_ms")), allowMissingColumns=True)
    path = streamed(i, lambda s, path: (make(s["rows"]), sink(path)), True, rows=(rows.unionByName(clock), part))
    return sinks.written(i.spark, path + "/alerts")


def levels(alerts: DataFrame, alert_id: Column) -> DataFrame:
    return alerts.select(alert_id.alias("alert_id"), timers.wall(F.unix_millis("alert_time")).alias("alert_time"), "level", timers.wall(F.col("changed_ms")).alias("changed"))


@query
def stream_missing_report(i: Inputs) -> DataFrame:
    rows = timers.alert_rows(i.live.where(F.col("outputdatetime") <= now())).where("linecode <> ''").select("company", "linecode", "event_ms")
    lines = timers.IdleLine(IDLE * 1000, STEP * 1000, None, event=True)
    recovered = F.when(F.col("level") == "NONE", F.col("changed_ms")).otherwise(0)
    made = on_the_clock(i, rows, now(), lambda s: timers.idle_lines(s, lines, "0 seconds").withColumn("recover_ms", recovered))
    return levels(made, S.line_alert_id())


@query
def stream_order_alerts(i: Inputs) -> DataFrame:
    rows = timers.alert_rows(i.live.where(F.col("outputdatetime") <= now())).drop("linecode")
    alerts = timers.OrderAlerts(escalate_ms=STEP * 1000, event=True, ttl_ms=None)
    made = on_the_clock(i, rows, now(), lambda s: timers.order_alerts(s, alerts, "0 seconds"))
    return levels(made, F.concat_ws(":", "alert_type", *timers.KEY))


SNAPSHOT_DAYS = 5


@query
def stream_order_snapshots(i: Inputs) -> DataFrame:
    snapshots = timers.OrderSnapshots(SNAPSHOT_DAYS * 86_400_000, event=True, ttl_ms=None)
    blank = {"alert_ms": F.lit(0).cast("bigint"), "recover_ms": F.lit(0).cast("bigint")}
    end = F.lit("2100-01-01").cast("timestamp_ntz")
    made = on_the_clock(i, timers.alert_rows(i.live).drop("linecode"), end, lambda s: timers.order_snapshots(s, snapshots, "0 seconds").withColumns(blank))
    return made.select(*timers.KEY, "order_quantity", "report_quantity", "achieve_rate", "plan_progress", "version")


LIMIT_DAYS = 30


@query
def stream_digest_limit(i: Inputs) -> DataFrame:
    """Which digests are sent, with at most as many as in a minute in any 30 days."""
    rows = digests(i).select(F.lit("all").alias("channel"), "company", "alert_type", timers.millis(F.col("flush")).alias("event_ms"))
    limit = timers.RollingLimit(window_ms=LIMIT_DAYS * 86_400_000, event=True, ttl_ms=None)
    made = on_the_clock(i, rows, F.lit("2100-01-01").cast("timestamp_ntz"), lambda s: timers.limited(s, limit, "0 seconds"), lambda path: sinks.rows_batch(path, "alerts"))
    return made.select("company", "alert_type", timers.wall(F.col("event_ms")).alias("flush"), "sent")


@query
def shift_windows(i: Inputs) -> DataFrame:
    """Changes by daily window that begins with the shift; windows are shift days."""
    day = F.window("event_time", "1 day", "1 day", "510 minutes")
    rows = i.log.select(day["start"].alias("shift_start"), S.shift_start(S.shift_date(F.col("event_time"))).alias("own"))
    return rows.groupBy("shift_start").agg(F.count("*").alias("changes"), F.count_if(F.col("own") != F.col("shift_start")).alias("differing"))


@query
def parsed_times(i: Inputs) -> DataFrame:
    """Times as sources write them: with a T, with a space, with milliseconds, and texts that are none."""
    day, form = F.col("createddate"), F.col("productionorderid") % 4
    text = F.when(form == 0, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss")).when(form == 1, F.date_format(day, "yyyy-MM-dd HH:mm:ss")).when(form == 2, F.date_format(day, "yyyy-MM-dd HH:mm:ss.SSS")).otherwise("soon")
    return i.dims["orders"].select("productionorderid", S.parse_time(text).alias("parsed"), S.parse_op_ts(text).alias("ms"))


@query
def next_levels(i: Inputs) -> DataFrame:
    """How many alerts stand at each level, and the level they rise to next."""
    return i.history.groupBy("alert_type", "level", S.escalate(F.col("level")).alias("next_level")).agg(F.count("*").alias("alerts"))


@query
def datasource_parity(i: Inputs) -> DataFrame:
    """Sources of databases with known and unknown names, by both readings."""
    db = F.when(F.col("productionorderid") % 7 == 0, F.concat(F.lit("x_"), "db_name")).otherwise(F.col("db_name"))
    rows = i.log.select(db.alias("db_name"))
    return rows.groupBy("db_name", S.datasource(F.col("db_name")).alias("datasource"), S.datasource(F.col("db_name"), "sql").alias("datasource_sql")).agg(F.count("*").alias("changes"))


@query
def digest_messages(i: Inputs) -> DataFrame:
    """The digests as a chat channel takes them."""
    raised = A.escalation_history(A.missing_report_alerts(i.live, now(), IDLE), now(), STEP).where("level <> 'NONE'")
    return digest.digest_messages(digest.digest_groups(raised, F.date_trunc("day", F.col("changed")).cast("timestamp_ntz")))


def sent(i: Inputs, log: DataFrame | None = None) -> dict[str, tuple[DataFrame, Column]]:
    """The changelogs of both channels as lines of JSON, each a source of its own."""
    rows, part = shared.stored(i.log if log is None else log, "log"), F.least(F.col("seq"), F.lit(PARTS))
    each = {name: fixtures.sent_reports(rows.where(c), placed=True) for name, c in (("lots", "tbl_name <> 'barcodeautomatic'"), ("scans", "tbl_name = 'barcodeautomatic'"))}
    return {name: (lines, part) for name, lines in each.items()}


def both(batch: Callable[[str], sinks.Batch]) -> Callable[[dict[str, DataFrame], str], Made]:
    """A sink that takes the envelopes of both channels."""
    return lambda s, path: (s["lots"].unionByName(s["scans"]), batch(path))


@query
def stream_raw_wide(i: Inputs) -> DataFrame:
    """From lines of JSON of both channels to the detail table by month, and its live rows."""
    path = streamed(i, both(lambda p: jobs.detail_batch(i.held, p, months=True)), lines=True, **sent(i))
    return wide.live_wide(sinks.written(i.spark, f"{path}/wide")).drop("tbl_name", "op", "seq", "shift_month")


@query
def stream_raw_audit(i: Inputs) -> DataFrame:
    """Deletions that the detail job audits, and messages that its topic has of them, by order or record."""
    path = streamed(i, both(lambda p: jobs.detail_batch(i.held, p, months=True)), lines=True, **sent(i))
    audit = sinks.written(i.spark, f"{path}/audit").groupBy("company", "table_name").agg(F.count("*").alias("deleted"))
    topic = i.spark.read.schema(sinks.LOG).json(f"{path}/topic")
    good, _ = changelog.parse_wide(topic)
    gone = good.where("is_deleted").groupBy("company", F.when(F.col("outputtype") == "MANUAL", "lot").otherwise("barcodeautomatic").alias("table_name")).agg(F.count("*").alias("messages"))
    return audit.join(gone, ["company", "table_name"], "full")


@query
def stream_dirty_lines(i: Inputs) -> DataFrame:
    """Lines that can't be used, by batch and reason."""
    key = F.col("record_id").cast("bigint")
    dirty = i.log.withColumns({"op": F.when((key % 97 == 1) & (F.col("op") == "c"), "t").otherwise(F.col("op")), "tbl_name": F.when(key % 83 == 3, "stock").otherwise(F.col("tbl_name")), "event_time": F.when((key % 79 == 4) & (F.col("op") == "c"), None).otherwise(F.col("event_time"))})
    path = streamed(i, both(lambda p: jobs.detail_batch(i.held, p, months=True)), lines=True, **sent(i, dirty))
    return i.spark.read.parquet(f"{path}/rows").groupBy("batch_id", "reason").agg(F.count("*").alias("records"))


@query
def stream_minute_images(i: Inputs) -> DataFrame:
    """From the images that envelopes carry, without any state."""
    return sinks.minutes(i.spark, streamed(i, both(lambda p: jobs.image_minutes_batch(i.held, p)), lines=True, **sent(i)))


@query
def stream_refreshed_dims(i: Inputs) -> DataFrame:
    """Lines are loaded again before each batch, database by database; one database can't be read, and the last load fails
    whole, so the one before serves. Orders stay as they were first loaded."""
    held: list[Callable[[], dict[str, DataFrame]]] = []
    loads = 0

    def make(s: dict[str, DataFrame], path: str) -> Made:
        nonlocal loads
        loads += 1
        made = i.dims["workcenters"].where("db_name <> 'mes_new_cq'").withColumn("linename", F.concat("linename", F.lit(f" v{loads}")))
        made.write.partitionBy("db_name").parquet(f"{path}/dims/load={loads}")

        def load() -> dict[str, DataFrame]:
            if loads == PARTS:
                raise OSError("no connection")
            read = lambda db, name: i.spark.read.parquet(f"{path}/dims/load={loads}/db_name={db}")
            lines, failed = changelog.load_dims(read, "workcenters")
            assert set(failed) == {"mes_new_cq"} and lines is not None
            return {**i.held, "workcenters": lines, "orders": i.held["orders"].withColumn("orderquantity", F.col("orderquantity") + loads)}

        if not held:
            held.append(sinks.refreshed(load, 0))
        return s["log"], sinks.wide_batch(held[0], path)

    path = streamed(i, make)
    return sinks.written(i.spark, f"{path}/wide").select("db_name", "record_id", "version", "linename", "orderquantity")


def alert_job(i: Inputs) -> str:
    """The folder of an alert job over the lines, on the event clock; the topic has every batch twice."""
    rows = timers.alert_rows(i.live.where(F.col("outputdatetime") <= now())).where("linecode <> ''").select("company", "linecode", "event_ms")
    lines = timers.IdleLine(IDLE * 1000, STEP * 1000, None, event=True)
    recovered = F.when(F.col("level") == "NONE", F.col("changed_ms")).otherwise(0)
    more = {"alert_id": S.line_alert_id(), "alert_type": F.lit("MISSING_REPORT"), "productionorder": F.lit(None).cast("string"), "recover_ms": recovered}
    folder: list[str] = []

    def sink(path: str) -> sinks.Batch:
        folder[:] = [path]
        send = jobs.alert_batch(path)

        def twice(df: DataFrame, batch_id: int) -> None:
            kept = df.persist()  # else each run would compute the stream's state again
            send(kept, batch_id)
            send(kept, batch_id)
            kept.unpersist()

        return twice

    on_the_clock(i, rows, now(), lambda s: timers.idle_lines(s, lines, "0 seconds").withColumns(more), sink)
    return folder[0]


@query
def stream_alert_topic(i: Inputs) -> DataFrame:
    """The alert topic, read once, by key and level."""
    path = alert_job(i)
    with stores(i.spark, False):
        sinks.start(sinks.read_log(i.spark, f"{path}/topic"), sinks.rows_batch(path, "once"), f"{path}/read").awaitTermination()
    level = F.get_json_object("value", "$.level")
    return sinks.written(i.spark, f"{path}/once").groupBy("key", level.alias("level")).agg(F.count("*").alias("messages"))


@query
def stream_alert_digest(i: Inputs) -> DataFrame:
    """Alerts in the digests of a job that runs its batches twice, by day and company."""
    rows = sinks.written(i.spark, f"{alert_job(i)}/digests")
    return rows.groupBy("flush", "company", "alert_type").agg(F.sum("alerts").alias("alerts"))


@query
def stream_windowed_minutes(i: Inputs) -> DataFrame:
    """Sums of minutes by event-time window, each given out once, when the watermark has passed it."""
    rows = timers.alert_rows(i.live).select("company", "linecode", "qty", "event_ms")
    made = lambda s: sinks.windowed_minutes(s.select(F.timestamp_millis("event_ms").alias("event_time"), "company", F.lit("").alias("workshop"), "linecode", F.lit("").alias("partcode"), F.col("qty").alias("qty_delta"), F.when(F.col("company").isNotNull(), 1).otherwise(0).alias("cnt_delta")))
    found = on_the_clock(i, rows, F.lit("2100-01-01").cast("timestamp_ntz"), made, lambda path: sinks.rows_batch(path, "alerts"))
    return found.where("company is not null").select(timers.wall(F.unix_millis("ts_minute")).alias("ts_minute"), "company", "linecode", "output_quantity", "record_cnt")

"""Changelog routing, deltas, live rows, alerts, digests and reconciliation on small frames."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shopfloor import schemas
from shopfloor.operators import alerts, digest, orders, reconcile, versions, wide
from shopfloor.sources import changelog

WIDE = "db_name string, tbl_name string, record_id string, op string, version bigint, seq bigint, company string, datasource string, outputtype string, productionorder string, orderquantity bigint, ordercreateddate timestamp_ntz, orderduedate timestamp_ntz, lotquantity decimal(38,4), outputdatetime timestamp_ntz, shift_date date, linecode string, workshop string, partcode string, productionorderid bigint, is_deleted boolean"


def row(record="1", op="c", version=1, qty="10", at="2024-05-02 10:00:00", order="PO-1", line="L1", plan=100, created="2024-05-01 00:00:00", due="2024-05-11 00:00:00", db="mes_old_zh"):
    t = lambda x: x and datetime.fromisoformat(x)
    from decimal import Decimal

    return (db, "lot", record, op, version, version, "zh", "OLD_MES", "MANUAL", order, plan, t(created), t(due), Decimal(qty), t(at), t(at).date(), line, "W", "PN1", 7, op == "d")


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), WIDE)


def deltas(df, parity=None):
    live = wide.counts(df) & ~F.col("is_deleted")
    out = versions.signed_deltas(df, live, ["record_id"], ["linecode", "outputdatetime"], parity)
    return sorted((r.version, float(r.qty_delta), r.cnt_delta, r.linecode) for r in out.collect())


def test_create_update_delete(spark):
    got = deltas(frame(spark, row(), row(op="u", version=2, qty="14"), row(op="d", version=3, qty="14")))
    assert got == [(1, 10, 1, "L1"), (2, -10, -1, "L1"), (2, 14, 1, "L1"), (3, -14, -1, "L1")]


def test_replayed_change_makes_no_delta(spark):
    assert deltas(frame(spark, row(), row())) == [(1, 10, 1, "L1")]


def test_moved_record_leaves_its_old_line(spark):
    rows = frame(spark, row(), row(op="u", version=2, line="L2"))
    assert deltas(rows)[1:] == [(2, -10, -1, "L1"), (2, 10, 1, "L2")]
    assert deltas(rows, "new_dims")[1:] == [(2, -10, -1, "L2"), (2, 10, 1, "L2")]


def test_update_to_nothing_leaves_the_live_view(spark):
    rows = frame(spark, row(), row(op="u", version=2, qty="0"))
    assert wide.live_wide(rows).count() == 0
    assert wide.live_wide(rows, "filter_first").count() == 1


def test_excluded_and_unknown_orders(spark):
    got = wide.live_wide(frame(spark, row("1", order="FG-9"), row("2", order=None), row("3"))).collect()
    assert sorted(r.record_id for r in got) == ["2", "3"]


@pytest.mark.parametrize("op,side", [("c", "after"), ("r", "after"), ("u", "after"), ("d", "before"), ("t", None), (None, None)])
def test_routing(spark, op, side):
    lines = spark.createDataFrame([('{"op":%s,"before":{"record_id":"before"},"after":{"record_id":"after"}}' % (f'"{op}"' if op else "null"),)], "value string")
    got = changelog.route_envelope(changelog.parse_envelopes(lines, schemas.REPORT)).select("row.record_id").first()
    assert got.record_id == side


def test_malformed_json_and_numbers_as_text(spark):
    lines = spark.createDataFrame([("{oops",), ('{"op":"c","after":{"finishedquantity":"1.5000"}}',), ('{"op":"c","after":{"finishedquantity":1.5}}',)], "value string")
    got = [r.finishedquantity for r in changelog.flatten(changelog.route_envelope(changelog.parse_envelopes(lines, schemas.REPORT))).collect()]
    assert got[0] is None and got[1] == got[2]


def test_over_report_is_strict(spark):
    exact = frame(spark, row("1", qty="60"), row("2", qty="40", at="2024-05-02 11:00:00"))
    assert alerts.over_report_alerts(exact).count() == 0
    over = exact.unionByName(frame(spark, row("3", qty="2", at="2024-05-02 12:00:00"), row("4", qty="2", at="2024-05-02 13:00:00")))
    assert [float(r.report_quantity) for r in alerts.over_report_alerts(over).collect()] == [102]


def test_lag_then_catch_up(spark):
    rows = frame(spark, row("1", qty="1", at="2024-05-06 00:00:00"), row("2", qty="90", at="2024-05-06 12:00:00"))
    (a,) = alerts.lag_alerts(rows, grain="order").collect()
    assert (a.alert_time, a.recover_time) == (datetime(2024, 5, 6), datetime(2024, 5, 6, 12))


def test_idle_for_exactly_the_threshold(spark):
    rows = frame(spark, row("1"), row("2", at="2024-05-02 11:00:00"))
    got = alerts.missing_report_alerts(rows, F.lit("2024-05-02 11:30:00").cast("timestamp_ntz"), 3600).collect()
    assert [(r.alert_time, r.recover_time) for r in got] == [(datetime(2024, 5, 2, 11), datetime(2024, 5, 2, 11))]
    assert alerts.missing_report_alerts(frame(spark, row(line="")), F.lit("2024-06-02").cast("timestamp_ntz"), 3600).count() == 0


@pytest.mark.parametrize("minutes,level", [(5, "P3"), (10, "P2"), (20, "P1"), (50, "P1")])
def test_escalation(spark, minutes, level):
    raised = alerts.missing_report_alerts(frame(spark, row()), F.lit("2024-05-02 12:00:00").cast("timestamp_ntz"), 3600)
    as_of = F.lit("2024-05-02 11:00:00").cast("timestamp_ntz") + F.expr(f"interval {minutes} minutes")
    assert alerts.current_alerts(alerts.escalation_history(raised, as_of, 600)).first().level == level


def test_digest_of_many_lines(spark):
    rows = spark.createDataFrame([("zh", "MISSING_REPORT", "P3" if k else "P2", f"L{k:02}", None, datetime(2024, 5, 2)) for k in range(25)], "company string, alert_type string, level string, linecode string, productionorder string, at timestamp_ntz")
    (d,) = digest.alert_digest(rows, F.col("at")).collect()
    assert d["level"] == "P2" and d["body"].count("L") == 20 and d["body"].endswith("... 25 items")
    sent = digest.rate_limit(digest.alert_digest(rows, F.col("at")), F.col("flush"), 0).first()
    assert sent.sent is False


def test_salted_sum_is_the_sum(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plain = versions.sum_merge(rows, ["k"], ["v"]).collect()
    assert sorted(plain) == sorted(versions.salted_sum(rows, ["k"], ["v"], ["v"], 5).collect())


def test_reconcile_tolerance_and_missing_side(spark):
    side = lambda *r: spark.createDataFrame(list(r), "k string, q int").select("k", F.col("q").cast("decimal(38,4)").alias("report_qty"))
    got = {r.k: r.within_tolerance for r in reconcile.reconcile(side(("a", 1000), ("b", 1000), ("c", 5)), side(("a", 1005), ("b", 1006)), ["k"]).collect()}
    assert got == {"a": True, "b": False, "c": False}


def test_attributes_of_the_last_or_first_version(spark):
    rows = frame(spark, row("1", version=1, plan=100), row("2", version=2, plan=200))
    now = F.lit("2024-06-01").cast("timestamp_ntz")
    assert orders.order_achievement(rows, now).first().order_quantity == 200
    assert orders.order_achievement(rows, now, parity="first_seen").first().order_quantity == 100


def test_asof_order(spark):
    changes = spark.createDataFrame([("d", 1, v) for v in (1, 3, 5)], "db_name string, productionorderid bigint, version bigint")
    history = spark.createDataFrame([("d", 1, 1, "c", 10), ("d", 1, 3, "u", 20), ("d", 1, 4, "d", 20)], "db_name string, productionorderid bigint, version bigint, op string, q int")
    got = {r.version: r.q for r in wide.asof_order_join(changes, history).select("version", "order.q").collect()}
    assert got == {1: 10, 3: 20, 5: None}


def test_package_over_the_boundary(spark):
    t = datetime.fromisoformat
    scans = spark.createDataFrame([("d", "P", 1, "m", "n", "u", 3, t("2024-05-02 08:00:00")), ("d", "P", 1, "m", "n", "u", 4, t("2024-05-02 09:00:00"))], "db_name string, lpnbarcode string, productionorderid bigint, modelencode string, model string, users string, quantity int, scantime timestamp_ntz")
    known = spark.createDataFrame([("d", 1, "PO-1", 5)], "db_name string, productionorderid bigint, productionorderno string, orderquantity bigint")
    (r,) = reconcile.baseline_lpn_shift(scans, known).collect()
    assert (str(r.shift_date), r.report_qty, r.lpn_cnt) == ("2024-05-02", 7, 1)


def test_changes_take_their_channels_own_quantity_and_time(spark):
    rows = spark.createDataFrame([("mes_old_zh", "lot", "c", "1", 5.0, None, "2024-01-01 08:00:00", None), ("mes_old_zh", "barcodeautomatic", "c", "2", None, 3, None, "2024-01-02 09:00:00")], "db_name string, tbl_name string, op string, record_id string, finishedquantity double, quantity int, createddate string, scantime string")
    rows = rows.withColumns({"finishedquantity": F.col("finishedquantity").cast("decimal(38,4)"), "createddate": F.col("createddate").cast("timestamp_ntz"), "scantime": F.col("scantime").cast("timestamp_ntz"), "op_ts": F.lit(None).cast("string")})
    got = {r.record_id: (float(r.qty), str(r.event_time), r.seq) for r in changelog.to_changes(rows).collect()}
    assert got == {"1": (5.0, "2024-01-01 08:00:00", 0), "2": (3.0, "2024-01-02 09:00:00", 0)}


def test_orders_that_cannot_be_used(spark):
    lines = spark.createDataFrame([(x,) for x in ('{"op":"c","after":{"db_name":"mes_old_zh","productionorderid":1}}', '{"op":"d","before":null}', '{"op":"t"}', "no json", '{"op":"u","after":{"db_name":"mes_old_zh"}}')], "value string")
    got = changelog.order_changes(changelog.parse_envelopes(lines, schemas.ORDER))
    assert sorted(r.reason or "" for r in got.collect()) == ["", "op", "op", "required", "required"]
    assert got.where("reason is null").first().orderquantity == 0


def test_results_are_read_in_order(spark):
    rows = spark.createDataFrame([("a", "w", "l", 1), ("b", "w", "l", 3), ("c", "w", "l", 2)], "company string, workshop string, linecode string, report_qty int")
    assert [r.company for r in reconcile.ordered(rows, "workshop_line").collect()] == ["b", "c", "a"]


def test_databases_that_fail_are_left_out(spark):
    def read(db, table):
        if db == "mes_old_hf":
            raise OSError("away")
        return spark.createDataFrame([(1,)], "userid int")

    found, failed = changelog.load_dims(read, "user")
    assert found.count() == 9 and set(failed) == {"mes_old_hf"}

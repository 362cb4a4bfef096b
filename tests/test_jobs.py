"""Jobs over raw changelogs and alerts: images, batches that run again, messages with signs that JSON escapes."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shopfloor.operators import digest
from shopfloor.schemas import REPORT
from shopfloor.sources import changelog, fixtures
from shopfloor.streaming import jobs, sinks

SF = "/root/testdata/sf0.001"


def envelopes(spark, path, lines):
    spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in lines], "value string").coalesce(1).write.text(path)
    return changelog.read_changelog(spark, path, REPORT, placed=True)


def image(record="1", qty=5, **more):
    return {"db_name": "mes_old_zh", "tbl_name": "lot", "record_id": record, "finishedquantity": qty, "createddate": "2024-05-02T08:30:00", "op_ts": "2024-05-02 00:00:00", **more}


def test_images_are_signed_and_what_lacks_one_is_told(spark, tmp_path):
    lines = [
        {"op": "c", "after": image(), "seq": 1},
        {"op": "u", "before": image(), "after": image(qty=7), "seq": 2},
        {"op": "u", "after": image(qty=9), "seq": 3},
        {"op": "d", "before": image(qty=9), "seq": 4},
        {"op": "d", "seq": 5},
        {"op": "r", "after": image("2", 1), "seq": 6},
        {"op": "c", "after": image(None), "seq": 7},
        {"op": "t", "after": image("3"), "seq": 8},
        "no json",
    ]
    read = envelopes(spark, str(tmp_path / "in"), lines)
    got = [(r.sign, r.record_id, int(r.finishedquantity), r.seq) for r in changelog.image_changes(read).collect()]
    assert sorted(got, key=lambda r: (r[3], r[0])) == [(1, "1", 5, 1), (-1, "1", 5, 2), (1, "1", 7, 2), (1, "1", 9, 3), (-1, "1", 9, 4), (1, "2", 1, 6)]
    assert sorted(r.seq for r in changelog.without_images(read).collect()) == [3, 5]


def test_a_batch_of_images_runs_again(spark, tmp_path):
    dims = fixtures.dims(spark, SF)
    read = envelopes(spark, str(tmp_path / "in"), [{"op": "c", "after": image(), "seq": 1}, {"op": "u", "before": image(), "after": image(qty=7), "seq": 2}, {"op": "d", "seq": 3}])
    batch = jobs.image_minutes_batch(dims, str(tmp_path))
    for _ in range(2):
        batch(read, 0)
    (row,) = sinks.minutes(spark, str(tmp_path)).collect()
    assert (row.ts_minute, row.company, float(row.output_quantity), row.record_cnt) == (datetime(2024, 5, 2, 8, 30), "zh", 7.0, 1)
    assert sinks.written(spark, str(tmp_path / "incomplete")).count() == 1


@pytest.mark.parametrize("months", [False, True])
def test_a_detail_batch_runs_again(spark, tmp_path, months):
    read = envelopes(spark, str(tmp_path / "in"), [{"op": "c", "after": image(), "seq": 1}, {"op": "d", "before": image(), "seq": 2}, {"op": "c", "after": image("2", createddate=None), "seq": 3}, "no json"])
    batch = jobs.detail_batch(fixtures.dims(spark, SF), str(tmp_path), months)
    for _ in range(2):
        batch(read, 0)
    wide = sinks.written(spark, str(tmp_path / "wide"))
    assert wide.count() == 2 and wide.where("productionorder = '' and linecode = ''").count() == 2
    assert ("shift_month" in wide.columns) == months and str(wide.first().shift_date) == "2024-05-02"
    assert sinks.written(spark, str(tmp_path / "audit")).count() == 1
    assert sorted(r.reason for r in sinks.written(spark, str(tmp_path / "dirty")).collect()) == ["op", "time"]
    assert spark.read.schema(sinks.LOG).json(str(tmp_path / "topic")).groupBy("id", "version", "seq").count().count() == 2


def test_a_batch_without_rows(spark, tmp_path):
    none = envelopes(spark, str(tmp_path / "in"), [{"op": "c", "after": image(), "seq": 1}]).where("seq < 0")
    dims = fixtures.dims(spark, SF)
    jobs.detail_batch(dims, str(tmp_path / "a"))(none, 0)
    jobs.image_minutes_batch(dims, str(tmp_path / "b"))(none, 0)


def test_messages_are_json_whatever_ids_hold(spark):
    rows = [("zh", 'a"b\\c\n', "P2", "MISSING_REPORT", None), ("zh", "d", "P1", "MISSING_REPORT", None), (None, None, "P3", "LAG", 'o"')]
    alerts = spark.createDataFrame(rows, "company string, linecode string, level string, alert_type string, productionorder string")
    groups = digest.digest_groups(alerts, F.lit("2024-05-02").cast("timestamp_ntz"), 1)
    got = {r.alert_type: json.loads(r.message) for r in digest.digest_messages(groups, 1).collect()}
    assert got["MISSING_REPORT"] == {"msgtype": "markdown", "markdown": {"title": "[P1] MISSING_REPORT - zh（共 2 条）", "text": '#### [P1] MISSING_REPORT - zh（共 2 条）\n- 产线：a"b\\c\n 等 2 项\n'}}


def test_alerts_of_a_batch_that_runs_again(spark, tmp_path):
    rows = [("LAG:zh:o", "LAG", "zh", None, "o", "P3", 1000, 0, 1000), ("LAG:zh:o", "LAG", "zh", None, "o", "NONE", 1000, 5000, 5000)]
    alerts = spark.createDataFrame(rows, "alert_id string, alert_type string, company string, linecode string, productionorder string, level string, alert_ms long, recover_ms long, changed_ms long")
    for _ in range(2):
        jobs.alert_batch(str(tmp_path))(alerts, 0)
    assert sorted((r.level, r.recover_time is None) for r in sinks.written(spark, str(tmp_path / "alerts")).collect()) == [("NONE", False), ("P3", True)]
    assert [r.alerts for r in sinks.written(spark, str(tmp_path / "digests")).collect()] == [1]
    sent = spark.read.schema(sinks.LOG).json(str(tmp_path / "topic"))
    assert sent.count() == 4 and sorted((r.id, r.version, r.seq, r.key) for r in sent.select("id", "version", "seq", "key").distinct().collect()) == [("LAG:zh:o", 1000, 2, "zh::o"), ("LAG:zh:o", 5000, 1, "zh::o")]

"""Shift days, rates, plan progress, parsing."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from shopfloor.functions import scalars as S


def one(spark, *columns, row=None):
    frame = spark.createDataFrame([row or {"x": 1}]) if row is None or isinstance(row, dict) else row
    return frame.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def ts(text):
    return F.lit(text).cast("timestamp_ntz")


def test_shift_day_boundaries(spark):
    got = one(spark, *[S.shift_date(ts(t)) for t in ("2024-05-02 08:29:59", "2024-05-02 08:30:00", "2024-05-03 03:00:00")])
    assert list(got) == [date(2024, 5, 1), date(2024, 5, 2), date(2024, 5, 2)]


def test_shift_start_and_end(spark):
    day = F.lit("2024-05-02").cast("date")
    assert list(one(spark, S.shift_start(day), S.shift_end(day))) == [datetime(2024, 5, 2, 8, 30), datetime(2024, 5, 3, 8, 30)]


def test_daily_window_with_offset_is_the_shift(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        at = F.lit("2024-05-02 08:30:00").cast("timestamp")
        got = spark.range(1).select(F.window(at, "1 day", "1 day", "30 minutes")["start"].cast("string").alias("s")).first()
        assert got.s == "2024-05-02 08:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rate_rounds_once_and_guards_zero(spark):
    d = lambda x: F.lit(x).cast("decimal(38,4)")
    got = one(spark, S.rate4(d("1"), F.lit(32)), S.rate4(d("5"), F.lit(0)), S.rate4(d("1"), F.lit(3)))
    assert list(got) == [Decimal("0.0313"), Decimal("0.0000"), Decimal("0.3333")]


def test_plan_progress(spark):
    a, b = ts("2024-01-01 00:00:00"), ts("2024-01-03 00:00:00")
    got = one(spark, *[S.plan_progress(a, b, ts(n)) for n in ("2023-12-31 00:00:00", "2024-01-02 00:00:00", "2024-02-01 00:00:00")], S.plan_progress(b, a, ts("2024-01-02 00:00:00")))
    assert [float(x) for x in got] == [0, 0.5, 1, 0]


def test_names_of_databases(spark):
    rows = spark.createDataFrame([("mes_old_zh",), ("mes_new_cq",), ("other",)], "db_name string").select(S.company(F.col("db_name")).alias("c"), S.datasource(F.col("db_name")).alias("d"), S.datasource(F.col("db_name"), "sql").alias("q")).collect()
    assert [tuple(r) for r in rows] == [("zh", "OLD_MES", "OLD_MES"), ("cq", "NEW_MES", "NEW_MES"), (None, None, "NEW_MES")]


def test_time_parsing(spark):
    got = one(spark, S.parse_time(F.lit("2024-05-02T08:30:00")), S.parse_time(F.lit("2024-05-02 08:30:00.5")), S.parse_time(F.lit("soon")), S.parse_op_ts(F.lit("1970-01-01 00:00:01")), S.parse_op_ts(F.lit("x")))
    assert list(got) == [datetime(2024, 5, 2, 8, 30), datetime(2024, 5, 2, 8, 30, 0, 500000), None, 1000, 0]


def test_escalation_order(spark):
    assert list(one(spark, *[S.escalate(F.lit(x)) for x in ("NONE", "P3", "P2", "P1")])) == ["P3", "P2", "P1", "P1"]

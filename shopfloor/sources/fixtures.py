"""Test inputs: production reports and dimensions derived from the generic tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopfloor import constants as K


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer").hint("merge"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    late = F.col("o_orderdate") + F.make_dt_interval((3 + key % 13).cast("int"))
    return joined.select(
        key.alias("productionorderid"),
        F.concat(F.lit("mes_"), F.when(key % 2 == 0, "old").otherwise("new"), F.lit("_"), F.get(F.array(*map(F.lit, K.SITES)), F.col("n_regionkey"))).alias("db_name"),
        F.concat(F.when(key % 33 == 0, "FG-").otherwise("PO-"), F.expr("o_orderkey div 2").cast("string")).alias("productionorderno"),
        (20 + key % 181).alias("orderquantity"),
        F.when(key % 200 == 3, 9999).otherwise(F.col("n_nationkey")).cast("bigint").alias("worksiteid"),
        F.when(key % 200 == 3, 999999999).otherwise(F.col("o_custkey")).cast("bigint").alias("partid"),
        F.col("o_orderdate").alias("createddate"),
        F.when(key % 100 == 7, F.col("o_orderdate") - F.expr("interval 1 hour")).otherwise(late).alias("duedate"),
        F.col("o_custkey").alias("custkey"),
        F.col("c_name").alias("custname"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per change of a report, both channels."""
    line, number = F.col("l_orderkey"), F.col("l_linenumber").cast("bigint")
    each = Window.partitionBy("l_orderkey", "l_linenumber")
    order = each.orderBy("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    # dealt once by order, which serves both the windows over a report and the join to orders
    rows = table(spark, sf_dir, "lineitem").repartition("l_orderkey").withColumns({"ver": F.row_number().over(order).cast("bigint"), "nver": F.count("*").over(each)})
    own = orders(spark, sf_dir).join(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("partid"), F.col("p_name").alias("partname")).hint("merge"), "partid", "left")
    joined = rows.join(own, line == F.col("productionorderid"))
    days = (F.abs(F.datediff("l_shipdate", "createddate")) % 20).cast("int")
    seconds = (line * 7919 + number * 104729) % 86400
    scan = F.col("db_name").startswith("mes_old_") & (number >= 5)
    return joined.select(
        "db_name",
        F.when(scan, "barcodeautomatic").otherwise("lot").alias("tbl_name"),
        F.when(F.col("ver") == 1, "c").when((F.col("ver") == F.col("nver")) & (F.col("l_returnflag") == "R"), "d").otherwise("u").alias("op"),
        (line * 10 + number).cast("string").alias("record_id"),
        F.col("ver").alias("version"),
        F.col("ver").alias("seq"),
        F.col("productionorderid"),
        F.col("l_suppkey").alias("workcenterid"),
        F.col("custkey").alias("createdbyid"),
        F.when(F.col("l_quantity") <= 1, 0).otherwise(F.col("l_quantity")).cast("decimal(38,4)").alias("qty"),
        (F.col("createddate") + F.make_dt_interval(days, F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))).alias("event_time"),
        F.concat(F.lit("LOT-"), (line * 10 + number).cast("string")).alias("lotno"),
        F.concat(F.lit("LPN-"), line.cast("string")).alias("lpnbarcode"),
        F.concat(F.lit("PN"), F.lpad(F.col("partid").cast("string"), 6, "0")).alias("modelencode"),
        F.col("partname").alias("model"),
        F.col("custname").alias("users"),
    )


def lots(changes: DataFrame) -> DataFrame:
    """The manual channel's source rows."""
    return changes.where("tbl_name = 'lot'").select("db_name", "tbl_name", "op", "record_id", "version", "seq", "productionorderid", "workcenterid", "createdbyid", "lotno", F.col("qty").alias("finishedquantity"), F.col("event_time").alias("createddate"))


def scans(changes: DataFrame) -> DataFrame:
    """The scan channel's source rows."""
    return changes.where("tbl_name = 'barcodeautomatic'").select("db_name", "tbl_name", "op", "record_id", "version", "seq", "productionorderid", "lpnbarcode", "modelencode", "model", "users", F.col("qty").cast("int").alias("quantity"), F.col("event_time").alias("scantime"))


def envelopes(changes: DataFrame) -> DataFrame:
    """op, before (the version before) and after (null for d)."""
    key, held = ["db_name", "tbl_name", "record_id"], ["productionorderid", "workcenterid", "qty", "event_time", "version"]
    # only what versions of a record can differ in is looked back at, so that rows aren't sorted with two images
    last = F.lag(F.struct(*held)).over(Window.partitionBy(*key).orderBy("version", "seq"))

    def image(of: Callable[[str], Column]) -> Column:
        return F.struct(*key, of("productionorderid").alias("productionorderid"), of("workcenterid").alias("workcenterid"), of("qty").alias("finishedquantity"), of("event_time").alias("createddate"), F.date_format(F.timestamp_seconds(of("version")), "yyyy-MM-dd HH:mm:ss").alias("op_ts"))

    rows = changes.select("op", *key, *held, last.alias("_last"))
    before = F.when(F.col("_last").isNotNull(), image(lambda c: F.col(f"_last.{c}")))
    return rows.select("op", before.alias("before"), F.when(F.col("op") != "d", image(F.col)).alias("after"), "record_id", "version")


def sent_reports(changes: DataFrame, placed: bool = False) -> DataFrame:
    """value and seq: the whole log of both channels as JSON envelopes, ``placed`` ones with seq inside; a deletion carries
    the row before it."""
    scan = F.col("tbl_name") == "barcodeautomatic"
    on, off = (lambda c: F.when(scan, F.col(c))), (lambda c: F.when(~scan, F.col(c)))
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    image = F.struct(
        "db_name", "tbl_name", "record_id", "productionorderid", off("workcenterid").alias("workcenterid"), off("createdbyid").alias("createdbyid"), off("lotno").alias("lotno"), *[on(c).alias(c) for c in ("lpnbarcode", "modelencode", "model", "users")],
        off("qty").alias("finishedquantity"), on("qty").cast("int").alias("quantity"), text(off("event_time")).alias("createddate"), text(on("event_time")).alias("scantime"), F.date_format(F.timestamp_seconds("version"), "yyyy-MM-dd HH:mm:ss").alias("op_ts"),
    )
    before = F.lag(image).over(Window.partitionBy("db_name", "tbl_name", "record_id").orderBy("version", "seq"))
    return changes.select(F.to_json(F.struct("op", before.alias("before"), F.when(F.col("op") != "d", image).alias("after"), *(["seq"] if placed else []))).alias("value"), "seq")


def order_history(orders: DataFrame) -> DataFrame:
    """Orders as they are made, with double quantity at version 2, and gone at version 4 if their number ends on 7; some
    without site."""
    own = orders.withColumn("worksiteid", F.when(F.col("productionorderid") % 50 == 9, None).otherwise(F.col("worksiteid")))
    step = lambda v, op, times: F.struct(F.lit(v).cast("bigint").alias("version"), F.lit(op).alias("op"), (times * F.col("orderquantity")).alias("_quantity"))
    made, gone = [step(1, "c", 1), step(2, "u", 2)], step(4, "d", 2)
    steps = own.select("*", F.inline(F.when(F.col("productionorderid") % 10 == 7, F.array(*made, gone)).otherwise(F.array(*made))))
    return steps.withColumn("orderquantity", F.col("_quantity")).drop("_quantity")


def sent_orders(history: DataFrame) -> DataFrame:
    """value: order changes as JSON envelopes."""
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c)
    image = F.struct("db_name", "productionorderid", "productionorderno", "orderquantity", "worksiteid", "partid", text("createddate"), text("duedate"), F.date_format(F.timestamp_seconds("version"), "yyyy-MM-dd HH:mm:ss").alias("op_ts"))
    gone = F.col("op") == "d"
    return history.select(F.to_json(F.struct("op", F.when(gone, image).alias("before"), F.when(~gone, image).alias("after"))).alias("value"))


def in_databases(rows: DataFrame) -> DataFrame:
    """The rows once for each database. By a join: Spark takes exploded rows for as large as before, and would broadcast
    dimensions that are ten times its limit, or after compression a hundred times."""
    number = F.col("id").cast("int")
    databases = rows.sparkSession.range(0, len(K.DATABASES), 1, 1).select(F.get(F.array(*map(F.lit, K.DATABASES)), number).alias("db_name"))
    return rows.crossJoin(F.broadcast(databases))


def dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    read = lambda t: table(spark, sf_dir, t)
    every = {
        "worksites": read("nation").select(F.col("n_nationkey").cast("bigint").alias("worksiteid"), F.col("n_name").alias("workshop")),
        "workcenters": read("supplier").select(F.col("s_suppkey").alias("workcenterid"), F.col("s_name").alias("linecode"), F.concat(F.lit("Line "), F.col("s_suppkey").cast("string")).alias("linename"), F.col("s_nationkey").cast("bigint").alias("wc_worksiteid"), (F.col("s_nationkey") % 6).cast("string").alias("workcentertype")),
        "parts": read("part").select(F.col("p_partkey").alias("partid"), F.concat(F.lit("PN"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("dim_partcode"), F.col("p_name").alias("dim_partname")),
        "users": read("customer").select(F.col("c_custkey").alias("createdbyid"), F.col("c_name").alias("dim_username")),
    }
    return {"orders": orders(spark, sf_dir).drop("custkey", "custname")} | {name: in_databases(rows) for name, rows in every.items()}

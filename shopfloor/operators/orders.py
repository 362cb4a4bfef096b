"""Order achievement against plan, by order and shift or by order, and by line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.functions import scalars as S

GRAINS = {"order_shift": ["shift_date", "company", "datasource", "productionorder"], "order": ["company", "datasource", "productionorder"]}
ATTRIBUTES = ["productionorderid", "workshop", "linecode", "partcode", "orderquantity", "ordercreateddate", "orderduedate"]


def order_achievement(live: DataFrame, now: Column, grain: str = "order_shift", parity: str | None = None) -> DataFrame:
    """Reported quantity, rate and plan progress of each order. Attributes are those of the last version;
    parity="first_seen" takes the first."""
    rank = F.struct("version", "record_id")
    pick = F.min_by if parity == "first_seen" else F.max_by
    out = live.groupBy(*GRAINS[grain]).agg(F.sum("lotquantity").alias("report_quantity"), F.max("outputdatetime").alias("last_report_time"), pick(F.struct(*ATTRIBUTES), rank).alias("a"))
    out = out.select(*GRAINS[grain], "report_quantity", "last_report_time", "a.*").withColumnRenamed("orderquantity", "order_quantity")
    created, due = F.col("ordercreateddate"), F.col("orderduedate")
    out = out.withColumns({"achieve_rate": S.rate4(F.col("report_quantity"), F.col("order_quantity")), "plan_progress": S.plan_progress(created, due, now)})
    return out.withColumns({"finished": S.is_finished(F.col("achieve_rate"), due, now), "progress_deviation": F.coalesce("achieve_rate", F.lit(0)) - F.coalesce("plan_progress", F.lit(0))})


def dim_achievement(achieved: DataFrame) -> DataFrame:
    """By site, workshop and line; an order's plan counts once however many shifts report on it."""
    keys = ["company", "workshop", "linecode"]
    once = achieved.groupBy(*keys, "datasource", "productionorder").agg(F.sum("report_quantity").alias("r"), F.max("order_quantity").alias("q"))
    out = once.groupBy(*keys).agg(F.sum("r").alias("report_qty"), F.sum("q").alias("order_qty"))
    return out.withColumn("achieve_rate", F.when(F.col("order_qty") != 0, S.rate4(F.col("report_qty"), F.col("order_qty"))))


def recompute_orders(live: DataFrame, now: Column) -> DataFrame:
    """The shift-grain snapshot as the batch layer writes it, with now as its version."""
    return order_achievement(live, now).drop("finished", "progress_deviation", "ordercreateddate", "orderduedate").withColumn("version", S.epoch(now) * 1000)


def order_running_qty(live: DataFrame, grain: str = "order_shift") -> DataFrame:
    """Each report with its order's quantity so far, in order of time and record."""
    w = Window.partitionBy(*GRAINS[grain]).orderBy("outputdatetime", "record_id", "outputtype").rowsBetween(Window.unboundedPreceding, 0)
    return live.withColumn("running_qty", F.sum("lotquantity").over(w))


def running_in_blocks(live: DataFrame, grain: str = "order_shift") -> DataFrame:
    """The same as ``order_running_qty``, for orders too large for one task: reports are summed within hours, and an hour
    begins with the sum of the hours before, so that only an order's hours are ever ordered together."""
    keys, hour = GRAINS[grain], F.date_trunc("hour", F.col("outputdatetime")).alias("_hour")
    before = Window.partitionBy(*keys).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    sums = live.groupBy(*keys, hour).agg(F.sum("lotquantity").alias("_sum"))
    sums = sums.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_hour").alias("_at"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, "_hour").orderBy("outputdatetime", "record_id", "outputtype").rowsBetween(Window.unboundedPreceding, 0)
    rows = live.select("*", hour).withColumn("_own", F.sum("lotquantity").over(inside))
    met = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("_hour").eqNullSafe(F.col("_at"))]
    return rows.join(sums, met).withColumn("running_qty", (F.col("_before") + F.col("_own")).cast("decimal(38,4)")).select(*live.columns, "running_qty")

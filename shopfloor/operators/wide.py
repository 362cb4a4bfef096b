"""The wide detail row: reports joined to order, part, line, workshop and user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor import constants as K
from shopfloor.functions import scalars as S
from shopfloor.operators.versions import RECORD, latest_by_version
from shopfloor.schemas import WIDE


#: Parts that rows without a key are dealt to where a join shuffles.
SPREAD = 1024


def met(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """A left join on db_name and key in which rows without a key, which meet nothing, are dealt over SPREAD parts of each
    database instead of one."""
    part = F.when(F.col(key).isNull(), 1 + F.pmod(F.xxhash64("record_id", "version", "seq"), F.lit(SPREAD))).otherwise(0)
    # always 0, but no constant: Spark would take a constant out of the keys that rows are dealt by
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    return rows.withColumn("_part", part).join(dim.withColumn("_part", zero), ["db_name", key, "_part"], "left").drop("_part")


def enrich(changes: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Every change in the wide columns, without filters; db_name, tbl_name, op and seq stay.

    Dimensions join on db_name and their id; Spark broadcasts those that are small. Manual reports take part, line and user
    from dimensions, scans from their own fields; a workshop comes by the order or else by the line.
    """
    db = F.col("db_name")
    rows = changes.withColumns({"company": S.company(db), "datasource": S.datasource(db), "outputtype": S.channel(F.col("tbl_name"))})
    manual = F.col("outputtype") == "MANUAL"
    orders = dims["orders"].withColumnsRenamed({"createddate": "ordercreateddate", "duedate": "orderduedate"})
    rows = met(rows, orders, "productionorderid")
    # scans don't look up part, line or user: a null key meets nothing
    rows = rows.withColumns({"partid": F.when(manual, F.col("partid")), "workcenterid": F.when(manual, F.col("workcenterid")), "createdbyid": F.when(manual, F.col("createdbyid"))})
    for name, key in (("parts", "partid"), ("workcenters", "workcenterid"), ("users", "createdbyid")):
        rows = met(rows, dims[name], key)
    rows = met(rows.withColumn("worksiteid", F.coalesce("worksiteid", "wc_worksiteid")), dims["worksites"], "worksiteid")
    by = lambda a, b: F.when(manual, F.col(a)).otherwise(F.col(b))
    built = rows.withColumns(
        {
            "productionorder": F.col("productionorderno"),
            "lpnbarcode": by("lotno", "lpnbarcode"),
            "username": by("dim_username", "users"),
            "partcode": by("dim_partcode", "modelencode"),
            "partname": by("dim_partname", "model"),
            "lotquantity": F.col("qty"),
            "outputdatetime": F.col("event_time"),
            "shift_date": S.shift_date(F.col("event_time")),
            "is_deleted": F.col("op") == "d",
        }
    )
    return built.select("db_name", "tbl_name", "op", "seq", *WIDE.fieldNames())


def counts(rows: DataFrame):
    """Whether a wide row counts: quantity above 0, and no excluded order."""
    order = F.col("productionorder")
    return (F.col("lotquantity") > 0) & (order.isNull() | ~order.startswith(K.EXCLUDED_PREFIX))


def live_wide(wide: DataFrame, parity: str | None = None) -> DataFrame:
    """The last version of each record if it counts and isn't deleted; parity="filter_first" drops versions that don't
    count before the last is found, parity="with_shift" keeps one row per shift day."""
    keys = [*RECORD, "shift_date"] if parity == "with_shift" else RECORD
    rows = wide.where(counts(wide)) if parity == "filter_first" else wide
    last = latest_by_version(rows, keys).where("not is_deleted")
    return last.where(counts(last))


def live_of(changes: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The same as ``live_wide`` of all changes in their wide columns, with only the last version of each record joined."""
    last = enrich(latest_by_version(changes, RECORD).where("op <> 'd'"), dims)
    return last.where(counts(last))


def asof_order_join(changes: DataFrame, orders: DataFrame) -> DataFrame:
    """Each change with its order as it was then: the last order row whose version isn't later."""
    keys = ["db_name", "productionorderid"]
    held = F.struct(*[c for c in orders.columns if c not in (*keys, "version", "op")])
    left = changes.select(*keys, "version", F.lit(1).alias("_side"), F.struct(*changes.columns).alias("_row"), F.lit(None).cast(orders.select(held.alias("o")).schema["o"].dataType).alias("_order"), F.lit(False).alias("_set"))
    right = orders.select(*keys, "version", F.lit(0).alias("_side"), F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), F.when(F.col("op") != "d", held).alias("_order"), F.lit(True).alias("_set"))
    w = Window.partitionBy(*keys).orderBy("version", "_side").rowsBetween(Window.unboundedPreceding, 0)
    # a deleted order is a null that counts
    both = left.unionByName(right).withColumn("_asof", F.last(F.when(F.col("_set"), F.struct(F.col("_order").alias("o"))), ignorenulls=True).over(w))
    return both.where("_side = 1").select("_row.*", F.col("_asof.o").alias("order"))


#: What is empty where a dimension was not found.
MISSING = {"order_miss": "productionorder", "part_miss": "partcode", "line_miss": "linecode", "workshop_miss": "workshop", "user_miss": "username"}


def dim_miss_profile(wide: DataFrame) -> DataFrame:
    """Rows whose dimensions were not found, by channel."""
    return wide.groupBy("outputtype").agg(F.count("*").alias("records"), *[F.count_if(F.coalesce(c, F.lit("")) == "").alias(k) for k, c in MISSING.items()])


def dim_miss_rows(changes: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """The changes whose key the dimension doesn't have."""
    return changes.join(dim.select(*keys), keys, "left_anti")

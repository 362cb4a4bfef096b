"""Reading, routing, checking and writing changelogs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopfloor import constants as K
from shopfloor import schemas
from shopfloor.functions import scalars as S
from shopfloor.operators.versions import latest_by_version


def read_changelog(spark: SparkSession, path: str, row: T.StructType, streaming: bool = False, placed: bool = False) -> DataFrame:
    """op, before, after from files with one JSON envelope a line; ``placed`` envelopes have seq too."""
    reader = spark.readStream if streaming else spark.read
    lines = reader.text(path)
    return parse_envelopes(lines.withColumn("seq", F.get_json_object("value", "$.seq").cast("bigint")) if placed else lines, row)


def read_kafka(spark: SparkSession, servers: str, topic: str, row: T.StructType, startup: str = "latest") -> DataFrame:
    """op, before, after from a topic; startup is earliest or latest."""
    if startup not in ("earliest", "latest"):
        raise ValueError(f"startup must be earliest or latest, not {startup}")
    stream = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", startup).load()
    return parse_envelopes(stream.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("seq")), row)


def write_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """key and value of a batch to a topic, or of a stream, whose query is started, with ``checkpoint``."""
    rows = messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    writer = (rows.writeStream.option("checkpointLocation", checkpoint) if checkpoint else rows.write).format("kafka")
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    return writer.start() if checkpoint else writer.save()


def parsed(row: T.StructType) -> Column:
    """``value`` from JSON. Exploded, for Spark pushes filters over what was parsed below a projection and there parses
    anew for each column that they name, but doesn't push them below a generator."""
    return F.explode(F.array(F.from_json("value", row)))


def parse_envelopes(lines: DataFrame, row: T.StructType) -> DataFrame:
    """op, before and after, and seq (the place in the log, which settles ties of versions) if the lines have it."""
    seq = ["seq"] if "seq" in lines.columns else []
    return lines.select(parsed(schemas.envelope(row)).alias("e"), *seq).select("e.op", "e.before", "e.after", *seq)


def parse_wide(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the wide topic, tombstones too, and the lines that are no such rows."""
    rows = lines.withColumn("w", parsed(schemas.WIDE))
    good = F.coalesce(F.col("w.record_id").isNotNull() & F.col("w.company").isNotNull(), F.lit(False))
    return rows.where(good).select("w.*"), rows.where(~good).select("value")


def databases(df: DataFrame, pattern: str) -> DataFrame:
    return df.where(F.col("db_name").rlike(f"^(?:{pattern})$"))


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame) -> DataFrame:
    """Snapshot rows count as version 0, before every change."""
    return snapshot.withColumn("version", F.lit(0).cast("bigint")).unionByName(changes, allowMissingColumns=True)


def load_dims(read: Callable[[str, str], DataFrame], table: str, skip: bool = True) -> tuple[DataFrame | None, dict[str, str]]:
    """One table of all databases with db_name, and the databases that failed if these are skipped."""
    out, failed = None, {}
    for db in K.DATABASES:
        try:
            own = read(db, table).withColumn("db_name", F.lit(db))
        except Exception as e:  # any reader's error counts as that database's failure
            if not skip:
                raise
            failed[db] = str(e)
            continue
        out = own if out is None else out.unionByName(own)
    return out, failed


def route_envelope(envelopes: DataFrame) -> DataFrame:
    """op and the row that counts: after for c, r and u, before for d; null for any other."""
    row = F.when(F.col("op") == "d", F.col("before")).when(F.col("op").isin("c", "r", "u"), F.col("after"))
    return envelopes.select("op", row.alias("row"), *(["seq"] if "seq" in envelopes.columns else []))


def image_changes(envelopes: DataFrame) -> DataFrame:
    """The images of usable envelopes as flattened rows with a sign: what an update or a deletion takes back, -1, and what a
    change, an update or a snapshot row adds, 1."""
    had = F.when(F.col("op").isin("u", "d"), F.col("before"))
    has = F.when(F.col("op").isin("c", "r", "u"), F.col("after"))
    image = lambda sign, row: F.struct(F.lit(sign).alias("sign"), row.alias("row"))
    both = envelopes.select("op", F.explode(F.array(image(-1, had), image(1, has))).alias("i"), *(["seq"] if "seq" in envelopes.columns else []))
    rows = flatten(both.where("i.row is not null").select("op", "i.row", "i.sign", *(["seq"] if "seq" in envelopes.columns else [])), ("sign",))
    return rows.where(dirty_reason().isNull())


def without_images(envelopes: DataFrame) -> DataFrame:
    """Updates and deletions that don't say what they replace."""
    return envelopes.where(F.col("op").isin("u", "d") & F.col("before").isNull())


def flatten(routed: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """op, the row's columns, ``more`` and its version in milliseconds; dirty rows keep nulls."""
    return routed.select("op", "row.*", *more, *(["seq"] if "seq" in routed.columns else [])).withColumn("version", S.parse_op_ts(F.col("op_ts")))


def to_changes(reports: DataFrame) -> DataFrame:
    """Flattened reports of both channels as changes that ``enrich`` takes: the quantity and the time of each one's channel,
    and seq, 0 where the log's place isn't known."""
    manual = S.channel(F.col("tbl_name")) == "MANUAL"
    qty = F.when(manual, F.col("finishedquantity")).otherwise(F.col("quantity").cast("decimal(38,4)"))
    out = reports.withColumns({"qty": qty, "event_time": F.coalesce("createddate", "scantime")})
    out = out if "seq" in reports.columns else out.withColumn("seq", F.lit(0).cast("bigint"))
    return out.drop("finishedquantity", "quantity", "createddate", "scantime", "op_ts")


NUMBERS = ("orderquantity", "worksiteid", "partid")


def order_changes(envelopes: DataFrame) -> DataFrame:
    """Flattened order changes: upserts with missing numbers as 0, and deletions; reason is set on those that can't be used."""
    flat = flatten(route_envelope(envelopes))
    known = F.coalesce(F.col("op").isin("c", "r", "u", "d"), F.lit(False))
    reason = F.when(~known, "op").when(F.col("productionorderid").isNull() | F.col("db_name").isNull(), "required")
    return flat.withColumns({c: F.coalesce(c, F.lit(0)) for c in NUMBERS}).withColumn("reason", reason)


def current_orders(changes: DataFrame) -> DataFrame:
    """The order dimension after all usable changes; a number of 0 is none that a dimension has."""
    order = ("version", "seq") if "seq" in changes.columns else ("version",)
    last = latest_by_version(changes.where("reason is null"), ["db_name", "productionorderid"], order).where("op <> 'd'")
    return last.select("db_name", "productionorderid", "productionorderno", "orderquantity", *[F.nullif(c, F.lit(0)).alias(c) for c in NUMBERS[1:]], "createddate", "duedate")


def ods_orders(changes: DataFrame) -> DataFrame:
    """Usable order changes as rows of the order topic, with site."""
    return with_site(changes.where("reason is null").drop("reason")).withColumn("tbl_name", F.lit("productionorder"))


def encode_orders(rows: DataFrame) -> DataFrame:
    """key and value of the order topic: an envelope with the row after, or before a deletion."""
    key = F.to_json(F.struct("company", "datasource", "productionorderid"))
    row, gone = F.struct(*[c for c in rows.columns if c not in ("op", "seq", "version")]), F.col("op") == "d"
    return rows.select(key.alias("key"), F.to_json(F.struct("op", F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"))).alias("value"))


def with_site(df: DataFrame, parity: str | None = None) -> DataFrame:
    db = F.col("db_name")
    return df.withColumns({"company": S.company(db), "datasource": S.datasource(db, parity)})


def dirty_reason() -> Column:
    """Why a flattened report cannot be used; null if it can."""
    time = F.coalesce("createddate", "scantime")
    return (
        F.when(F.col("op").isNull() | ~F.col("op").isin("c", "r", "u", "d"), "op")
        .when(F.col("record_id").isNull() | F.col("db_name").isNull() | F.col("tbl_name").isNull(), "required")
        .when(S.channel(F.col("tbl_name")).isNull(), "channel")
        .when(time.isNull(), "time")
    )


def split_dirty(reports: DataFrame) -> tuple[DataFrame, DataFrame]:
    tagged = reports.withColumn("reason", dirty_reason())
    return tagged.where("reason is null").drop("reason"), tagged.where("reason is not null")


def unify_lot(lots: DataFrame) -> DataFrame:
    """Manual reports in the columns of both channels."""
    none = {c: F.lit(None).cast("string") for c in ("lpnbarcode", "modelencode", "model", "users")}
    return lots.withColumns({"outputtype": F.lit("MANUAL"), "quantity": F.lit(None).cast("int"), "scantime": F.lit(None).cast("timestamp_ntz"), **none})


def unify_barcode(scans: DataFrame) -> DataFrame:
    """Scans in the columns of both channels."""
    none = {"workcenterid": "bigint", "createdbyid": "bigint", "lotno": "string", "finishedquantity": "decimal(38,4)", "createddate": "timestamp_ntz"}
    return scans.withColumns({"outputtype": F.lit("BARCODE"), **{c: F.lit(None).cast(t) for c, t in none.items()}})


def unify_reports(lots: DataFrame, scans: DataFrame) -> DataFrame:
    return with_site(unify_lot(lots).unionByName(unify_barcode(scans)))


def encode_changelog(df: DataFrame, keys: list[str]) -> DataFrame:
    """key and value of a report or order topic; nulls are left out of the JSON."""
    return df.select(F.to_json(F.struct(*keys)).alias("key"), F.to_json(F.struct("op", "before", "after")).alias("value"))


def wide_message(names: list[str]) -> dict[str, Column]:
    """key and value of the wide topic: by order, or by record where there is none."""
    return {"key": F.coalesce(F.nullif("productionorder", F.lit("")), "record_id"), "value": F.to_json(F.struct(*names))}


def encode_wide(wide: DataFrame) -> DataFrame:
    return wide.select(*[c.alias(n) for n, c in wide_message(wide.columns).items()])


def encode_alert(alerts: DataFrame, also: dict[str, Column] | None = None) -> DataFrame:
    """key and value of the alert topic, and what else is wanted beside them."""
    key = F.concat_ws(":", *[F.coalesce(c, F.lit("")) for c in ("company", "linecode", "productionorder")])
    more = [c.alias(n) for n, c in (also or {}).items()]
    return alerts.select(*more, F.when(key == "::", F.col("alert_id")).otherwise(key).alias("key"), F.to_json(F.struct(*alerts.columns)).alias("value"))

"""Alert digests by window, site and type, and their rate limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor import constants as K


def digest_groups(alerts: DataFrame, flush: Column, items: int = K.DIGEST_ITEMS) -> DataFrame:
    """Per flush, company and type: the highest level, alerts, distinct ids, and the first ``items`` of them in order
    (list). MISSING_REPORT names lines, the others orders.

    Distinct ids are ranked before they are gathered, so no group holds more than ``items``.
    """
    keys = ["flush", "company", "alert_type"]
    severity = F.array_position(F.array(*map(F.lit, K.LEVELS)), F.col("level"))
    item = F.coalesce(F.when(F.col("alert_type") == "MISSING_REPORT", F.col("linecode")).otherwise(F.col("productionorder")), F.lit("-"))
    rows = alerts.withColumns({"flush": flush, "severity": severity, "item": item})
    each = rows.groupBy(*keys, "item").agg(F.count("*").alias("n"), F.max("severity").alias("severity"))
    total = each.groupBy(*keys).agg(F.sum("n").alias("alerts"), F.count("*").alias("items"), F.max("severity").alias("severity"))
    few = each.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("item"))).where(F.col("_n") <= items)
    few = few.groupBy(*keys).agg(F.array_sort(F.collect_list("item")).alias("list"))
    level = F.get(F.array(*map(F.lit, K.LEVELS)), F.col("severity").cast("int") - 1)
    return total.join(few, keys).select(*keys, level.alias("level"), "alerts", "items", "list")


def alert_digest(alerts: DataFrame, flush: Column, items: int = K.DIGEST_ITEMS) -> DataFrame:
    """One message per flush, company and type; beyond ``items`` only the number of ids is told."""
    out = digest_groups(alerts, flush, items)
    more = F.when(F.col("items") > items, F.concat(F.lit(" ... "), F.col("items").cast("string"), F.lit(" items"))).otherwise("")
    text = F.concat(F.lit("["), F.col("level"), F.lit("] "), F.col("alert_type"), F.lit(" "), F.col("company"), F.lit(": "), F.array_join("list", ", "), more)
    return out.select("flush", "company", "alert_type", "level", "alerts", "items", text.alias("body"))


# The words of a channel's message.
NAMED, COUNTED, CUT, COMMA = {"MISSING_REPORT": "产线"}, "（共 {} 条）", " 等 {} 项", "、"
OTHERS = "订单"


def digest_messages(groups: DataFrame, items: int = K.DIGEST_ITEMS) -> DataFrame:
    """The JSON that a chat channel takes for each of ``digest_groups``: a title and a text in Markdown. Quotes, backslashes
    and control characters of ids are escaped as JSON wants them."""
    number = lambda words: F.concat(F.lit(words.split("{}")[0]), F.col("items").cast("string"), F.lit(words.split("{}")[1]))
    title = F.concat(F.lit("["), F.col("level"), F.lit("] "), F.col("alert_type"), F.lit(" - "), F.coalesce("company", F.lit("")), F.when(F.col("items") > 1, number(COUNTED)).otherwise(""))
    kind = F.coalesce(F.create_map(*[F.lit(x) for kv in NAMED.items() for x in kv])[F.col("alert_type")], F.lit(OTHERS))
    text = F.concat(F.lit("#### "), title, F.lit("\n- "), kind, F.lit("："), F.array_join("list", COMMA), F.when(F.col("items") > items, number(CUT)).otherwise(""), F.lit("\n"))
    message = F.to_json(F.struct(F.lit("markdown").alias("msgtype"), F.struct(title.alias("title"), text.alias("text")).alias("markdown")))
    return groups.select("flush", "company", "alert_type", "items", message.alias("message"))


def rate_limit(digests: DataFrame, bucket: Column, most: int = K.DIGESTS_PER_MINUTE) -> DataFrame:
    """Which digests of a bucket are sent: the first ``most``, by time, company and type."""
    w = Window.partitionBy("bucket").orderBy("flush", "company", "alert_type")
    return digests.withColumn("bucket", bucket).withColumn("sent", F.row_number().over(w) <= most)

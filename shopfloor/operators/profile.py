"""Quality counters of a changelog, as a table and as observed metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from shopfloor.operators.wide import counts


def quality_profile(wide: DataFrame) -> DataFrame:
    """Changes by site and channel: all, dirty, deleted, filtered, and those whose order is unknown."""
    kept = F.coalesce(counts(wide), F.lit(False))
    return wide.groupBy("company", "outputtype").agg(F.count("*").alias("changes"), F.count_if(F.col("outputtype").isNull() | F.col("outputdatetime").isNull()).alias("dirty"), F.count_if("is_deleted").alias("deleted"), F.count_if(~kept).alias("filtered"), F.count_if(F.col("productionorder").isNull()).alias("order_miss"))


def alert_counters(history: DataFrame) -> DataFrame:
    """Alerts fired, by type and level they rose to."""
    return history.where("level <> 'NONE'").groupBy("alert_type", "level").agg(F.count("*").alias("fired"))


def observed(wide: DataFrame, name: str = "quality") -> tuple[DataFrame, Observation]:
    """The rows as they are, and their counters once an action has run over them."""
    seen = Observation(name)
    kept = F.coalesce(counts(wide), F.lit(False))
    return wide.observe(seen, F.count(F.lit(1)).alias("changes"), F.count_if("is_deleted").alias("deleted"), F.count_if(~kept).alias("filtered")), seen

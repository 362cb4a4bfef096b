"""Minute output from signed deltas or live rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.functions import scalars as S
from shopfloor.operators.versions import salted_sum, sum_merge
from shopfloor.schemas import MINUTE_KEY

SUMS = ["output_quantity", "record_cnt"]
CARRIED = ["outputdatetime", "company", "datasource", "productionorder", "workshop", "linecode", "linename", "partcode"]


def minute_rows(deltas: DataFrame) -> DataFrame:
    return deltas.withColumns({"ts_minute": S.minute_floor(F.col("outputdatetime")), "output_quantity": F.col("qty_delta"), "record_cnt": F.col("cnt_delta")})


def minute_output(deltas: DataFrame, drop_zero: bool = True) -> DataFrame:
    return sum_merge(minute_rows(deltas), MINUTE_KEY, SUMS, ("linename",), drop_zero)


def minute_salted(deltas: DataFrame, buckets: int = 8) -> DataFrame:
    return salted_sum(minute_rows(deltas), MINUTE_KEY, SUMS, ["record_id", "version"], buckets, ("linename",))


def recompute_minute(live: DataFrame) -> DataFrame:
    """The same from the live rows alone."""
    rows = live.withColumns({"qty_delta": F.col("lotquantity"), "cnt_delta": F.lit(1).cast("bigint")})
    return minute_output(rows, drop_zero=False)

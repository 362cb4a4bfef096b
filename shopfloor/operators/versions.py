"""Versioned and additive tables: latest version per key, signed deltas, sums on read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RECORD = ["db_name", "tbl_name", "record_id"]


def latest_by_version(df: DataFrame, keys: list[str], order: tuple[str, ...] = ("version", "seq")) -> DataFrame:
    """The last version of each key; ties go by the columns after the first."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def sum_merge(df: DataFrame, keys: list[str], sums: list[str], carried: tuple[str, ...] = (), drop_zero: bool = False) -> DataFrame:
    """Rows of equal keys added up; drop_zero leaves out keys whose sums are all 0."""
    out = df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums], *[F.min(c).alias(c) for c in carried])
    if not drop_zero:
        return out
    zero = F.lit(True)
    for c in sums:
        zero = zero & (F.col(c) == 0)
    return out.where(~zero)


def salted_sum(df: DataFrame, keys: list[str], sums: list[str], salt_of: list[str], buckets: int, carried: tuple[str, ...] = ()) -> DataFrame:
    """The sums of keys in two shuffles: a hot key's rows first meet in ``buckets`` parts."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_of), F.lit(buckets)))
    return sum_merge(sum_merge(salted, [*keys, "_salt"], sums, carried), keys, sums, carried)


def signed_deltas(rows: DataFrame, live: Column, keys: list[str], carried: list[str], parity: str | None = None) -> DataFrame:
    """Changes as signed rows: what the record had is taken back, what it has is added.

    ``carried`` (dimensions and time) are those of the row that is taken back; parity="new_dims" takes back with those of
    the row that replaces it. Rows of one version and seq are one change.
    """
    w = Window.partitionBy(*keys).orderBy("version", "seq")
    once = rows.dropDuplicates([*keys, "version", "seq"]).withColumn("_live", F.coalesce(live, F.lit(False)))
    own = F.struct(*carried, F.col("lotquantity"))
    before = F.lag(F.struct("_live", own.alias("row"))).over(w)
    seen = once.withColumn("_before", before)
    back = F.struct(*[(F.col(c) if parity == "new_dims" else F.col(f"_before.row.{c}")).alias(c) for c in carried], (-F.col("_before.row.lotquantity")).cast("decimal(38,4)").alias("qty_delta"), F.lit(-1).cast("bigint").alias("cnt_delta"))
    on = F.struct(*carried, F.col("lotquantity").cast("decimal(38,4)").alias("qty_delta"), F.lit(1).cast("bigint").alias("cnt_delta"))
    both = F.array_compact(F.array(F.when(F.col("_before._live"), back), F.when(F.col("_live"), on)))
    return seen.select(*keys, "version", "seq", F.explode(both).alias("d")).select(*keys, "version", "seq", "d.*")


def version_audit(rows: DataFrame, key: str = "record_id", top: int = 50) -> DataFrame:
    """Keys with the most versions, and their first and last."""
    found = rows.groupBy(key).agg(F.count("*").alias("versions"), F.min("version").alias("first_version"), F.max("version").alias("last_version"))
    return found.where("versions > 1").orderBy(F.desc("versions"), key).limit(top)


def delete_audit(rows: DataFrame, audit_time: Column | None = None) -> DataFrame:
    """Deleted reports with their whole row as JSON."""
    return rows.where("op = 'd'").select("record_id", "company", F.col("tbl_name").alias("table_name"), F.col("version").alias("ts_ms"), F.to_json(F.struct(*rows.columns)).alias("payload"), (audit_time if audit_time is not None else F.current_timestamp()).alias("audit_time"))

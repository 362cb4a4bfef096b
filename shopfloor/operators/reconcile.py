"""Result grains, the batch baseline, and their comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor import constants as K
from shopfloor.functions import scalars as S


def between(df: DataFrame, start: str | None, end: str | None, column: str = "outputdatetime") -> DataFrame:
    """Rows from start on and before end."""
    out = df if start is None else df.where(F.col(column) >= F.lit(start).cast("timestamp_ntz"))
    return out if end is None else out.where(F.col(column) < F.lit(end).cast("timestamp_ntz"))


def totals(df: DataFrame, keys: list[str], quantity: str = "lotquantity", count: str = "record_cnt") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(quantity).alias("report_qty"), F.count("*").alias(count))


def recon_site_shift(live: DataFrame) -> DataFrame:
    return totals(live, ["company", "shift_date", "outputtype"])


def recon_workshop_line(live: DataFrame) -> DataFrame:
    return totals(live, ["company", "workshop", "linecode"])


def recon_order(live: DataFrame, with_datasource: bool = True) -> DataFrame:
    keys = ["company", *(["datasource"] if with_datasource else []), "productionorder"]
    out = live.groupBy(*keys).agg(F.max("orderquantity").alias("order_qty"), F.sum("lotquantity").alias("report_qty"))
    return out.withColumn("achieve_rate", F.when(F.col("order_qty") != 0, S.rate4(F.col("report_qty"), F.col("order_qty"))))


def with_orders(reports: DataFrame, orders: DataFrame) -> DataFrame:
    """Reports of known orders that aren't excluded."""
    kept = orders.where(~F.col("productionorderno").startswith(K.EXCLUDED_PREFIX)).select("db_name", "productionorderid", "productionorderno", "orderquantity")
    return reports.join(kept, ["db_name", "productionorderid"])


def baseline_manual_shift(lots: DataFrame, orders: DataFrame) -> DataFrame:
    rows = with_orders(lots.where("finishedquantity > 0"), orders).withColumns({"shift_date": S.shift_date(F.col("createddate")), "channel": F.lit("MANUAL")})
    return totals(rows, ["db_name", "shift_date", "channel"], "finishedquantity")


def baseline_lpn_shift(scans: DataFrame, orders: DataFrame) -> DataFrame:
    """Scans summed by package first; a package counts on the shift day of its last scan."""
    rows = package_scans(scans, orders).withColumn("channel", F.lit("BARCODE"))
    return totals(rows, ["db_name", "shift_date", "channel"], "qty", "lpn_cnt")


def baseline_workshop_line(lots: DataFrame, orders: DataFrame, workcenters: DataFrame, worksites: DataFrame) -> DataFrame:
    sites = worksites.withColumnRenamed("worksiteid", "wc_worksiteid")
    rows = with_orders(lots.where("finishedquantity > 0"), orders).join(workcenters, ["db_name", "workcenterid"], "left").join(sites, ["db_name", "wc_worksiteid"], "left")
    return totals(rows, ["db_name", "workshop", "linecode"], "finishedquantity")


def baseline_order_rate(lots: DataFrame, orders: DataFrame) -> DataFrame:
    rows = with_orders(lots.where("finishedquantity > 0"), orders)
    out = rows.groupBy("db_name", F.col("productionorderno").alias("productionorder"), F.col("orderquantity").alias("order_qty")).agg(F.sum("finishedquantity").alias("report_qty"))
    return out.withColumn("achieve_rate", F.when(F.col("order_qty") != 0, S.rate4(F.col("report_qty"), F.col("order_qty"))))


def reconcile(baseline: DataFrame, result: DataFrame, keys: list[str], tolerance: float = K.TOLERANCE) -> DataFrame:
    """Both quantities side by side, the difference as a share of the baseline, and whether it is within tolerance; a side
    that is missing counts as 0, and missing keys are equal."""
    zero = F.lit(0).cast("decimal(38,4)")
    sides = [df.select(*keys, *[(F.col("report_qty").cast("decimal(38,4)") if own else zero).alias(c) for own, c in zip(which, ("baseline_qty", "result_qty"), strict=True)]) for df, which in ((baseline, (True, False)), (result, (False, True)))]
    out = sides[0].unionByName(sides[1]).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("baseline_qty", "result_qty")])
    gap = F.abs(F.col("result_qty") - F.col("baseline_qty"))
    return out.withColumns({"diff": F.col("result_qty") - F.col("baseline_qty"), "within_tolerance": gap <= F.lit(tolerance).cast("decimal(10,6)") * F.abs(F.col("baseline_qty"))})


def sides(baseline: DataFrame, result: DataFrame, levels: list[str], record: list[str]) -> DataFrame:
    """Rows of both sides, each with ``qty``, in the columns levels, record, baseline_qty, baseline_cnt, result_qty and
    result_cnt."""
    qty, one, no = F.col("qty").cast("decimal(38,4)"), F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    zero = F.lit(0).cast("decimal(38,4)")
    of = lambda df, own: df.select(*levels, *record, *[c.alias(n) for c, n in zip((qty, one, zero, no) if own else (zero, no, qty, one), SIDES, strict=True)])
    return of(baseline, True).unionByName(of(result, False))


SIDES = ("baseline_qty", "baseline_cnt", "result_qty", "result_cnt")


def group_hashes(both: DataFrame, levels: list[str], record: list[str]) -> DataFrame:
    """Sums of the finest groups, and of each side the sum of its rows' hashes, which no order of rows changes. Two seeds
    make 128 bits."""
    row = lambda side, seed: F.when(F.col(f"{side}_cnt") > 0, F.xxhash64(F.lit(seed), *record, f"{side}_qty")).otherwise(0).cast("decimal(38,0)")
    hashes = {f"{side}_h{seed}": F.sum(row(side, seed)) for side in ("baseline", "result") for seed in (1, 2)}
    return both.groupBy(*levels).agg(*[F.sum(c).alias(c) for c in SIDES], *[h.alias(n) for n, h in hashes.items()])


def unequal() -> Column:
    return (F.col("baseline_h1") != F.col("result_h1")) | (F.col("baseline_h2") != F.col("result_h2"))


def difference_tree(baseline: DataFrame, result: DataFrame, levels: list[str], record: list[str], tolerance: float = K.TOLERANCE) -> DataFrame:
    """The groups of every level (``level`` columns deep, 0 being all) whose rows differ between the sides, with their
    sums, how many finest groups below differ, and whether the sums are within tolerance, as opposite differences are.

    Both sides are read and shuffled once, for the finest groups; the levels above are added up from these.
    """
    finest = group_hashes(sides(baseline, result, levels, record), levels, record)
    own = finest.withColumn("unequal", unequal()).select(*levels, "unequal", *SIDES)
    above = own.rollup(*levels).agg(F.grouping_id().alias("_id"), F.count_if("unequal").alias("groups"), *[F.sum(c).alias(c) for c in SIDES]).where("groups > 0")
    level = F.lit(len(levels)) - F.bit_count(F.col("_id"))
    gap = F.abs(F.col("result_qty") - F.col("baseline_qty"))
    return above.select(level.cast("bigint").alias("level"), *levels, "groups", *SIDES, (gap <= F.lit(tolerance).cast("decimal(10,6)") * F.abs(F.col("baseline_qty"))).alias("within_tolerance"))


def differing_records(baseline: DataFrame, result: DataFrame, levels: list[str], record: list[str]) -> DataFrame:
    """The records behind the groups whose hashes differ: quantity and rows of each side, where they aren't equal.

    Only rows of such groups are grouped by record; missing keys are equal. A group in which the sides' rows are the same
    by 128 bits is taken for equal.
    """
    both = sides(baseline, result, levels, record)
    some = group_hashes(both, levels, record).where(unequal()).select(*[F.col(c).alias(f"_{c}") for c in levels])
    same = F.lit(True)
    for c in levels:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    out = both.join(some, same, "left_semi").groupBy(*levels, *record).agg(*[F.sum(c).alias(c) for c in SIDES])
    return out.where("baseline_qty <> result_qty or baseline_cnt <> result_cnt")


def package_scans(scans: DataFrame, orders: DataFrame) -> DataFrame:
    """The source's packages of known orders, each with the sum of its scans, on the shift day of the last of them."""
    last = scans.groupBy("db_name", "lpnbarcode", "productionorderid", "modelencode", "model", "users").agg(F.sum("quantity").alias("qty"), F.max("scantime").alias("at")).where("qty > 0")
    return with_orders(last, orders).withColumn("shift_date", S.shift_date(F.col("at"))).withColumnRenamed("productionorderno", "productionorder")


#: How results are read, by grain: columns, falling where marked.
ORDERS = {"site_shift": ["company", "shift_date"], "workshop_line": ["-report_qty", "company", "workshop", "linecode"], "order": ["-achieve_rate", "company", "productionorder"], "dimension": ["achieve_rate", "company", "workshop", "linecode"]}


def ordered(df: DataFrame, grain: str) -> DataFrame:
    """The result in the order of its grain."""
    return df.orderBy(*[F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in ORDERS[grain]])


def total_check(minutes: DataFrame, live: DataFrame) -> DataFrame:
    """Minute total against detail total, by site and over all."""
    rows = minutes.select("company", F.lit("minute").alias("side"), F.col("output_quantity").alias("q")).unionByName(live.select("company", F.lit("detail").alias("side"), F.col("lotquantity").alias("q")))
    one = lambda side: F.sum(F.when(F.col("side") == side, F.col("q")).otherwise(0))
    return rows.rollup("company").agg(one("minute").alias("minute_qty"), one("detail").alias("detail_qty"))

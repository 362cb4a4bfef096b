"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark's setting by which a query's shuffle files go when it ends.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, else, on one machine alone, under one made for it; it goes when the
    session ends."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, target = place(spark, path)
    fs.deleteOnExit(target)
    return path


def place(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path as it takes it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder that nothing reads any more."""
    fs, target = place(spark, path)
    fs.delete(target, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table that is made once; the shuffle files that it took go at once, so that only the table stays."""
    return in_slices(df, [], lambda rows: rows, name, 1)


def in_slices(rows: DataFrame, keys: list[str], make: Callable[[DataFrame], DataFrame], name: str, slices: int) -> DataFrame:
    """``make`` of all rows as a table. It is made slice after slice of the keys' hash, so that the disk holds the shuffles
    of one slice at a time; rows of a key are in one slice, and ``make`` must not join across keys."""
    spark = rows.sparkSession
    path = folder(spark, name)
    with cleaned(spark):
        for k in range(slices):
            own = make(rows.where(F.pmod(F.xxhash64(*keys), F.lit(slices)) == k) if slices > 1 else rows)
            own.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(own.schema).parquet(path)


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """Within this, shuffle files of each write go when it ends."""
    before = spark.conf.get(CLEAN)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN, before)

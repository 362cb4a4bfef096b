"""Helpers shared by the operators: shared storage, Arrow text buffers, byte hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Spark's setting by which a query's shuffle files go when it ends.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting for the most rows that it hands to Python at once.
HANDED = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Odd multiplier of the byte hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, else, on one machine alone, one made for this
    session."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


def stored(df: DataFrame, name: str, handed: int | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back; this cuts lineage and survives lost
    executors. The shuffles that made it go at once, the table with ``release`` or when the session ends. Where rows are
    large, ``handed`` is how many of them Python gets at once at most, for both sides hold a batch in memory."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    held = {CLEAN: "true"} | ({HANDED: str(handed)} if handed else {})
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    folder(spark, path)[0].deleteOnExit(folder(spark, path)[1])
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def folder(spark: SparkSession, path: str) -> tuple:
    """The file system of a path, and the path as it takes it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def release(*tables: DataFrame) -> None:
    """Deletes stored tables once all that reads them is stored itself."""
    for t in tables:
        fs, target = folder(t.sparkSession, t.stored_at)
        fs.delete(target, True)


def text_key(text: str = "text") -> Column:
    """Together with doc_id this names a row; rows that repeat both are alike in every result."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def fresh(df: DataFrame, n: int) -> list[str]:
    """``n`` names that no column of ``df`` has."""
    mark = "_" * (1 + max([len(c) - len(c.lstrip("_")) for c in df.columns], default=0))
    return [f"{mark}{k}" for k in range(n)]


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z alone."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string or binary column in one array, and len + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else pa.binary()
    column = column.cast(kind).fill_null(b"")
    _, off, data = column.buffers()
    width = np.int64 if kind == pa.large_binary() else np.int32
    off = np.frombuffer(off, width, count=len(column) + 1, offset=column.offset * np.dtype(width).itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, for bounded memory; one row at least."""
    _, off = buffers(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield batch.slice(at, min(end, n) - at)
        at = min(end, n)


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row."""
    off = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, kind))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a hash depend on all of its input; for arrays."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(max(n, 1), U64)
    out[0] = 1
    out[1:] = U64(base)
    return np.multiply.accumulate(out)


class ByteHash:
    """Hashes of any byte ranges of one buffer, each in constant time, from a running polynomial."""

    _table = mix(np.arange(1, 257, dtype=U64) * U64(0xD1B54A32D192ED03))
    _pow = powers(BASE, 1 << 16)
    _inv = powers(BASE_INV, 1 << 16)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if n > len(ByteHash._pow):
            size = 1 << n.bit_length()
            ByteHash._pow, ByteHash._inv = powers(BASE, size), powers(BASE_INV, size)
        self.sums = np.zeros(n, U64)
        np.cumsum(self._table[data] * self._pow[: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self._inv[start] + U64(0x632BE59BD9B4E019) * (end - start).astype(U64))


def runs(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each longest run of bytes whose value has ``inside[value]``; none crosses a row."""
    ok = inside[data]
    first = np.zeros(len(data) + 1, bool)
    first[off[:-1]] = True  # of a row
    prev = np.zeros(len(data), bool)
    prev[1:] = ok[:-1]
    start = np.flatnonzero(ok & (~prev | first[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = ok[1:]
    end = np.flatnonzero(ok & (~after | first[1:] | (np.arange(len(data)) == len(data) - 1))) + 1
    return start, end, np.searchsorted(off, start, "right") - 1


#: The byte values with A-Z lower-cased, and those inside words: of letters, digits and all that is not ASCII; of all
#: but white space.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
SOLID = np.ones(256, bool)
SOLID[[9, 10, 11, 12, 13, 32]] = False


def word_hashes(column: pa.Array, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, lower-cased in A-Z, of all rows in order, and how many words each row has."""
    data, off = buffers(column)
    start, end, row = runs(data, off, inside)
    return ByteHash(LOWER[data]).of(start, end), np.bincount(row, minlength=len(column))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k words in a row."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, U64)
    for i in range(k):
        out = mix(out * U64(0x9FB21C651E98DF25) + words[i : i + n])
    return out


class Among:
    """A Bloom filter over ids, to leave out rows before they are shuffled to an exact join. Its size is bounded: past
    that it lets more through, which costs time alone."""

    MOST = 1 << 26

    def __init__(self, ids: DataFrame):
        """``ids`` has one column, without nulls."""
        column, n = ids.columns[0], ids.count()
        self.bits = min(self.MOST, 1 << max(16, (12 * n).bit_length()))
        each = ids.select(F.explode(self.places(column)).alias("p"))
        words = each.groupBy((F.col("p") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("set")).toArrow()
        self.set = np.zeros(self.bits // 64, np.int64)
        self.set[words.column("word").to_numpy()] = words.column("set").to_numpy()

    def places(self, column: str) -> Column:
        """The three bits of an id, as an array; for rows to be tested, as column ``places``."""
        return F.array(*[F.pmod(F.xxhash64(F.col(column), F.lit(i)), F.lit(self.bits)) for i in range(3)])

    def mask(self, batch: pa.RecordBatch) -> pa.Array:
        at = batch.column("places").flatten().to_numpy()
        return pa.array(((self.set[at >> 6] >> (at & 63)) & 1).reshape(-1, 3).all(1))

"""Operator 9: token files with a wavelet matrix per shard.

Documents in ascending doc_id order are cut into shards; the ids of a shard are one wavelet matrix, written with its
document bounds as one compressed blob. A plane holds one bit of each id, the highest bit first; below a plane, ids
whose bit is 0 come before those whose bit is 1. Rank on the planes reads single ids, counts an id in a range and
finds its occurrences without unpacking the rest; all ids come back by undoing the planes from the lowest up.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm import common, tokens

VOCABULARY, END, SHARD = "byte_bpe_50k.json", 0, 1 << 20

# Fixed values of the file format.
MAGIC, WORD = b"WMX1", 64


class WaveletMatrix:
    """Planes of packed bits, most significant first, over n ids of ``bits`` bits."""

    def __init__(self, planes: list[np.ndarray], zeros: list[int], n: int):
        self.planes, self.zeros, self.n = planes, zeros, n
        self._ranks: list[np.ndarray] | None = None

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = ids.astype(np.uint32)
        bits = max(1, int(ids.max(initial=0)).bit_length())
        ids = ids.astype(np.uint16) if bits <= 16 else ids
        planes, zeros = [], []
        for level in range(bits - 1, -1, -1):
            bit = (ids & ids.dtype.type(1 << level)) != 0
            planes.append(np.packbits(bit, bitorder="little"))
            low, high = np.flatnonzero(~bit), np.flatnonzero(bit)
            zeros.append(len(low))
            ids = np.concatenate([ids.take(low), ids.take(high)])
        return cls(planes, zeros, len(ids))

    def to_bytes(self) -> bytes:
        import zstandard

        head = MAGIC + struct.pack(f"<QI{len(self.planes)}Q", self.n, len(self.planes), *self.zeros)
        return head + zstandard.ZstdCompressor(level=1).compress(b"".join(p.tobytes() for p in self.planes))

    @classmethod
    def from_bytes(cls, blob: bytes) -> WaveletMatrix:
        import zstandard

        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        n, bits = struct.unpack_from("<QI", blob, 4)
        zeros = list(struct.unpack_from(f"<{bits}Q", blob, 16))
        size = (n + 7) // 8
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[16 + 8 * bits :], max_output_size=size * bits), np.uint8)
        return cls([raw[k * size : (k + 1) * size] for k in range(bits)], zeros, n)

    def ids(self) -> np.ndarray:
        """All ids, by undoing the planes from the last to the first."""
        out = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for level, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros), strict=True)):
            bit = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            up = np.empty_like(out)
            up[np.flatnonzero(~bit)] = out[:zeros]
            up[np.flatnonzero(bit)] = out[zeros:] | out.dtype.type(1 << level)
            out = up
        return out.astype(np.uint32)

    def _rank(self, k: int, i: int) -> int:
        """Ones of plane k before i: a count at each word's start, then the bits of one word."""
        if self._ranks is None:
            self._ranks = []
            for p in self.planes:
                p = np.pad(p, (0, -len(p) % 8))
                self._ranks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(p.view("<u8")), dtype=np.int64)]))
        word, rest = divmod(i, WORD)
        part = self.planes[k][word * 8 : word * 8 + (rest + 7) // 8].tobytes()
        return int(self._ranks[k][word]) + (int.from_bytes(part, "little") & ((1 << rest) - 1)).bit_count()

    def access(self, i: int) -> int:
        value = 0
        for k, zeros in enumerate(self.zeros):
            bit = self.planes[k][i >> 3] >> (i & 7) & 1
            ones = self._rank(k, i)
            value, i = value << 1 | int(bit), zeros + ones if bit else i - ones
        return value

    def _range(self, value: int, i: int, j: int) -> tuple[int, int]:
        if value >> len(self.planes):
            return 0, 0
        for k, zeros in enumerate(self.zeros):
            a, b = self._rank(k, i), self._rank(k, j)
            i, j = (zeros + a, zeros + b) if value >> (len(self.planes) - 1 - k) & 1 else (i - a, j - b)
        return i, j

    def count(self, value: int, i: int, j: int) -> int:
        """Occurrences of an id at positions i to j - 1."""
        a, b = self._range(value, i, j)
        return b - a

    def _select(self, k: int, bit: int, nth: int) -> int:
        low, high = 0, self.n  # the least position with nth + 1 such bits up to it
        while low < high:
            mid = (low + high) // 2
            ones = self._rank(k, mid + 1)
            if (ones if bit else mid + 1 - ones) > nth:
                high = mid
            else:
                low = mid + 1
        return low

    def occurrence(self, value: int, nth: int) -> int:
        """The position of an id's nth occurrence, from 0; -1 if there are fewer."""
        a, b = self._range(value, 0, self.n)
        if not 0 <= nth < b - a:
            return -1
        at = a + nth
        for k in range(len(self.planes) - 1, -1, -1):
            one = value >> (len(self.planes) - 1 - k) & 1
            at = self._select(k, one, at - self.zeros[k] if one else at)
        return at


SHARDS = "part int, shard int, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, blob binary"


def write_shards(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END, shard: int = SHARD) -> DataFrame:
    """A row per shard in ascending doc_id order: part, shard, n_tokens, doc_ids, lengths, blob. A shard ends with the
    document that brings it to ``shard`` ids or more, so its memory is bounded by that and one document.

    Null and empty texts have the end id alone; rows with a null doc_id come first; repeated rows are kept.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = tokens.encoder(vocabulary).encode, TaskContext.get().partitionId()
        held, n, k = [], 0, 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([x[1] for x in held])
            doc_ids, lens = [d for x in held for d in x[0]], [v for x in held for v in x[2]]
            blob = WaveletMatrix.build(ids).to_bytes()
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([k], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())), pa.array([lens], pa.list_(pa.int64())), pa.array([blob], pa.binary())], names=["part", "shard", "n_tokens", "doc_ids", "lengths", "blob"])

        for batch in (x for b in batches for x in common.slices(b, "text", 1 << 20)):
            ids, counts = encode(["" if t is None else t for t in batch.column("text").to_pylist()])
            ids, counts = np.insert(ids, np.cumsum(counts), end), counts + 1
            held.append((batch.column("doc_id").to_pylist(), ids, counts.tolist()))
            n += len(ids)
            if n >= shard:
                yield flush()
                held, n, k = [], 0, k + 1
        if held:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(build, SHARDS)


def read_shards(shards: DataFrame) -> DataFrame:
    """A row per document from stored shards: doc_id, start, ids (little-endian unsigned 32-bit)."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows))):
            raw = WaveletMatrix.from_bytes(row["blob"]).ids().astype("<u4").tobytes()
            ends = np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            blobs = [raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["before"], pa.int64()), pa.array(blobs, pa.binary())], names=["doc_id", "start", "ids"])

    return with_starts(shards).select("before", "doc_ids", "lengths", "blob").mapInArrow(unpack, "doc_id bigint, start bigint, ids binary")


def with_starts(shards: DataFrame) -> DataFrame:
    """Adds ``before``, the ids of all shards before each: totals per part (as many rows as the writer had tasks),
    then a running sum inside the part."""
    counts = shards.select("part", "shard", "n_tokens")
    parts = counts.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    base = parts.withColumn("base", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select("part", F.coalesce("base", F.lit(0)).alias("base"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    at = counts.withColumn("inside", F.coalesce(inside, F.lit(0))).join(base, "part").select("part", "shard", (F.col("base") + F.col("inside")).alias("before"))
    return shards.join(at, ["part", "shard"])


def token_file(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END, shard: int = SHARD) -> DataFrame:
    """Writes the shards to the shared folder and returns what is read back from them."""
    return read_shards(common.stored(write_shards(docs, vocabulary, end, shard), "tokens"))

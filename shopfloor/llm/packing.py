"""Operator 6: packing by power-of-two decomposition.

The binary digits of a document's token count cut it into pieces of 2**k tokens, the largest first; a document of
over ``most`` tokens gives whole pieces of ``most`` first. Each piece is a sequence by itself, so no sequence crosses
documents and none needs padding; sequences of one length share a bucket and fill batches of one shape.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm import common, tokens

VOCABULARY, END, MOST = "word_bpe_49k.json", 2, 4096


def decompose(n: int, most: int = MOST) -> list[int]:
    """Lengths of the pieces of n tokens: powers of two, at most ``most``, in falling order."""
    rest = n % most
    return [most] * (n // most) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END, most: int = MOST) -> DataFrame:
    """A row per piece: doc_id, start, length, doc_tokens, ids (little-endian unsigned 32-bit), bucket, sequence_id
    and offset.

    One pass without a shuffle; memory is that of a few MB of text and its ids. Null and empty texts have the end id
    alone. Repeated rows are packed each by itself; a null doc_id stays null. Other columns are not read. ``most``
    must be a power of two. Sequence ids are distinct and follow the partitions of ``docs``.
    """
    if most & (most - 1):
        raise ValueError("most must be a power of two")
    schema = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(vocabulary).encode
        for batch in (part for b in batches for part in common.slices(b, "text", 1 << 20)):
            ids, counts = encode(["" if t is None else t for t in batch.column("text").to_pylist()])
            at, rows, starts, lens, sizes, blobs = 0, [], [], [], [], []
            for row, n in enumerate(counts.tolist()):
                own = np.append(ids[at : at + n], np.uint32(end)).astype("<u4").tobytes()
                at, start = at + n, 0
                for length in decompose(n + 1, most):
                    rows.append(row)
                    starts.append(start)
                    lens.append(length)
                    sizes.append(n + 1)
                    blobs.append(own[4 * start : 4 * (start + length)])
                    start += length
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64()), pa.array(lens, pa.int64()), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())], names=["doc_id", "start", "length", "doc_tokens", "ids"])

    pieces = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, schema)
    return pieces.withColumns({"bucket": F.log2(F.col("length").cast("double")).cast("int"), "sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")})


def write_buckets(packed: DataFrame, path: str) -> None:
    """The sequences as files, a folder for each length."""
    packed.select("bucket", "sequence_id", "doc_id", "start", "length", "ids").write.partitionBy("bucket").parquet(path)

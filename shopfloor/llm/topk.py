"""Operator 5: exact top-k search by inner product on a bit-sliced index.

Components become integers. A block of rows is stored as one bitmap per component and bit. A query's component times
a block's component is a sum of bitmaps, one for each pair of their bits; full adders on whole bitmaps add all of them
into the slices of the scores. Rows are then taken from the most significant slice downward, and rows that tie with the
last place are settled by their ids. Rows lie in blocks of bounded size; queries go to all of them, a bounded number at a
time, and a task keeps only the best of its blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm.common import stored

SCALE, BLOCK, QUERIES, TOGETHER = 1024, 4096, 1024, 64
#: Bytes of queries that go to every task at once, and blocks with a part of queries that Spark hands to Python at once.
AT_ONCE, HAND = 8 << 20, 4
#: Bits of magnitude that rows of one block or queries of one part may differ in.
LIKE = 16
#: Largest magnitude of the plain 64-bit path: sums over 2**20 components fit.
PLAIN = 1 << 20
#: Pairs of bits of a component and a weight past which products are taken plainly.
WIDE = 4096
LEAST_LONG, MOST_LONG = -(1 << 63), (1 << 63) - 1


def usable(embedding: str = "embedding") -> Column:
    """Neither null nor with a component that is null or not finite."""
    bad = F.exists(F.col(embedding), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(embedding).isNotNull() & ~bad, F.lit(False))


def width(v: str = "v") -> Column:
    """A class of the largest magnitude, in steps of LIKE bits; small ones share a class."""
    most = F.aggregate(F.col(v), F.lit(0.0), lambda m, x: F.greatest(m, F.abs(x)))
    return F.greatest(F.lit(0), F.ceil((F.log2(F.greatest(most, F.lit(1e-300))) + 10 - 20) / LIKE)).cast("int")


def quantised(rows: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of every component: 64-bit integers if all are under PLAIN, else Python's."""
    with np.errstate(over="ignore"):
        scaled = np.floor(rows * scale)
    if not rows.size or np.abs(scaled).max() < PLAIN:
        return scaled.astype(np.int64)
    exact = [int(y) if np.isfinite(y) else int(x) * scale for x, y in zip(rows.ravel().tolist(), scaled.ravel().tolist(), strict=True)]
    return np.array(exact, object).reshape(rows.shape)


def sortable(n: int) -> bytes:
    """Bytes whose order is that of the integers."""
    raw = abs(n).to_bytes((abs(n).bit_length() + 7) // 8, "big")
    return (32768 + len(raw)).to_bytes(2, "big") + raw if n >= 0 else (32768 - len(raw)).to_bytes(2, "big") + bytes(255 - x for x in raw)


def bitmap(flags: np.ndarray) -> np.ndarray:
    """Bits of the last axis, in 64-bit words."""
    pad = -flags.shape[-1] % 64
    flags = np.pad(flags, [(0, 0)] * (flags.ndim - 1) + [(0, pad)])
    return np.ascontiguousarray(np.packbits(flags, axis=-1, bitorder="little")).view("<u8")


def slices_of(rows: np.ndarray) -> tuple[np.ndarray, int]:
    """Bitmaps [component, bit, word] of rows [row, component] less the least value, and that value."""
    low = int(rows.min()) if rows.size else 0
    up = (rows - low).T
    bits = max(1, int(up.max()).bit_length()) if rows.size else 1
    return np.stack([bitmap((up >> j & 1).astype(bool)) for j in range(bits)], 1), low


def scores(index: np.ndarray, low: int, queries: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Slices [query, word] of a number for each query and row, and what to add to it for the inner product.

    A negative weight takes the complement of the row's bits instead: -w * u = w * (top - u) - w * top.
    """
    dims, bits, words = index.shape
    weight, negative = np.abs(queries), (queries < 0).astype(bool)
    top = (1 << bits) - 1
    # in Python's integers, as are numbers of any size below
    extra = np.array([low * sum(q) - top * sum(-x for x in q if x < 0) for q in queries.tolist()], object)
    flip = np.where(negative, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)).T[:, :, None]
    width = max(1, int(weight.max(initial=0)).bit_length())
    has = [np.where((weight >> t & 1).astype(bool), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)).T[:, :, None] for t in range(width)]
    out, carried, w = [], [], 0
    while w < bits + width - 1 or carried:
        held, carries = [], []
        addends = ((index[d, j] ^ flip[d]) & has[w - j][d] for j in range(max(0, w - width + 1), min(bits, w + 1)) for d in range(dims))
        for x in (*carried, *addends):
            held.append(x)
            if len(held) == 3:
                a, b, c = held
                ab = a ^ b
                carries.append((a & b) | (ab & c))
                held = [ab ^ c]
        if len(held) == 2:
            carries.append(held[0] & held[1])
            held = [held[0] ^ held[1]]
        out.append(held[0] if held else np.zeros((len(queries), words), np.uint64))
        carried, w = carries, w + 1
    return out, extra


def best(slices: list[np.ndarray], allowed: np.ndarray, k: int) -> list[np.ndarray]:
    """Rows of each query's k greatest numbers among the allowed ones; those that tie with the last go by row number."""
    sure, even = np.zeros_like(allowed), allowed.copy()
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    for s in reversed(slices):
        more = sure | (even & s)
        n = np.bitwise_count(more).sum(1, dtype=np.int64)[:, None]
        over = np.where(n > k, ones, np.uint64(0))
        sure = np.where(n > k, sure, more)
        even &= ~(s ^ over)  # too many: go on among those with the bit; else among those without
    out = []
    for g, e in zip(sure, even, strict=True):
        first = np.flatnonzero(np.unpackbits(g.view(np.uint8), bitorder="little"))
        tied = np.flatnonzero(np.unpackbits(e.view(np.uint8), bitorder="little"))
        out.append(np.concatenate([first, tied[: max(0, k - len(first))]])[:k])
    return out


def value_of(slices: list[np.ndarray], query: int, rows: np.ndarray) -> np.ndarray:
    out = np.zeros(len(rows), object)
    for w, s in enumerate(slices):
        out += (s[query, rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)).astype(object) << w
    return out


def plain_best(index: np.ndarray, low: int, ids: np.ndarray, who: int, query: list[int], k: int) -> list[tuple[int, int]]:
    """(row, score) by products of Python's integers, for numbers so wide that the adders would take one step for each pair
    of their bits."""
    bits = [np.unpackbits(x.view(np.uint8), axis=-1, bitorder="little")[:, : len(ids)].astype(object) for x in index]
    rows = [low + sum(b << j for j, b in enumerate(d)) for d in bits]
    found = sum((q * r for q, r in zip(query, rows, strict=True)), np.zeros(len(ids), object)).tolist()
    return sorted(((i, s) for i, s in enumerate(found) if ids[i] != who), key=lambda x: (-x[1], x[0]))[:k]


def first(found: list[tuple], k: int) -> list[tuple]:
    """The k greatest places, ties to smaller ids."""
    return sorted(sorted(found, key=lambda row: row[2]), key=lambda row: row[4], reverse=True)[:k]


def build_index(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per block of vectors of one length and magnitude: dims, width, block, ids (ascending), bits, low, bitmaps."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        n = table.num_rows
        dims = table.column("dims")[0].as_py()
        index, low = slices_of(quantised(table.column("v").combine_chunks().flatten().to_numpy().reshape(n, dims)))
        return pa.table({"dims": table.column("dims")[:1], "width": table.column("width")[:1], "block": table.column("block")[:1], "ids": pa.array([table.column("id").to_pylist()], pa.list_(pa.int64())), "bits": pa.array([index.shape[1]], pa.int32()), "low": pa.array([str(low)]), "bitmaps": pa.array([index.tobytes()], pa.binary())})

    return vectors.groupBy("dims", "width", "block").applyInArrow(build, "dims int, width int, block bigint, ids array<bigint>, bits int, low string, bitmaps binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = BLOCK, per: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k greatest integer inner products, ties to the smaller vec_id.

    Both frames have vec_id and embedding. Null ids, and vectors that are null or hold null or non-finite components, take
    no part; vectors of different lengths do not meet, empty ones have 0 as product. Rows that share the query's vec_id are
    not its candidates; other repeated rows each count. A repeated query row is one query. Empty tables give no rows. Other
    columns are not read. Products are exact and ranked as such; one that no long holds is given as the nearest long.
    """
    schema = "query_id bigint, form bigint, vec_id bigint, score bigint, place binary"

    def prepared(df: DataFrame) -> DataFrame:
        rows = df.where(F.col("vec_id").isNotNull() & usable()).select(F.col("vec_id").cast("bigint").alias("id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
        return rows.withColumns({"dims": F.size("v"), "width": width()})

    rows, asked = prepared(vectors), prepared(queries).distinct()
    n_rows, (n_asked, most_dims) = rows.count(), asked.agg(F.count(F.lit(1)), F.max("dims")).first()
    blocks, parts = max(1, -(-n_rows // block)), max(1, -(-n_asked // per))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)))
    form = F.xxhash64("v")
    sets = asked.withColumn("part", F.pmod(F.xxhash64("id", "v"), F.lit(parts))).groupBy("dims", F.col("width").alias("query_width"), "part").agg(F.collect_list(F.struct("id", form.alias("form"), "v")).alias("asked"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most: dict[tuple[int, int], list[tuple]] = {}  # the task's best of each query
        for b in (x.slice(i, 1) for x in batches for i in range(x.num_rows)):
            dims, bits, low = (int(b.column(c)[0].as_py()) for c in ("dims", "bits", "low"))
            ids = b.column("ids").flatten().to_numpy()
            index = np.frombuffer(b.column("bitmaps")[0].as_buffer(), np.uint64).reshape(dims, bits, -(-len(ids) // 64))
            asked = b.column("asked").flatten()
            who, forms, v = (asked.field(i) for i in range(3))
            who, forms, v = who.to_numpy(), forms.to_numpy(), quantised(v.flatten().to_numpy().reshape(len(who), dims))
            found = []
            put = lambda q, i, x: found.append((int(who[q]), int(forms[q]), int(ids[i]), max(LEAST_LONG, min(MOST_LONG, x)), sortable(x)))  # noqa: B023, E731
            wide = bits * int(np.abs(v).max(initial=0)).bit_length() > WIDE
            for q in range(len(who) if wide else 0):
                for i, x in plain_best(index, low, ids, who[q], v[q].tolist(), k):
                    put(q, i, x)
            for at in range(0, 0 if wide else len(who), TOGETHER):
                own = slice(at, at + TOGETHER)
                sums, extra = scores(index, low, v[own])
                picked = best(sums, bitmap(ids[None, :] != who[own][:, None]), k)
                for q, r in enumerate(picked):
                    for i, x in zip(r.tolist(), (value_of(sums, q, r) + extra[q]).tolist(), strict=True):
                        put(at + q, i, x)
            for row in found:
                own = most.setdefault(row[:2], [])
                own.append(row)
                if len(own) >= 4 * k:
                    own[:] = first(own, k)
        left = [row for own in most.values() for row in first(own, k)]
        kinds = [pa.int64()] * 4 + [pa.binary()]
        for at in range(0, len(left), 10_000):
            cols = zip(*left[at : at + 10_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["query_id", "form", "vec_id", "score", "place"])

    order = Window.partitionBy("query_id", "form").orderBy(F.desc("place"), "vec_id")

    def ranked(asked: DataFrame) -> DataFrame:
        """All blocks meet some of the queries, which every task gets: AT_ONCE bytes of them at most, or one part."""
        met = build_index(rows, block).join(F.broadcast(asked), "dims").select("dims", "bits", "low", "ids", "bitmaps", "asked")
        found = met.mapInArrow(search, schema)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    together = max(1, AT_ONCE // max(1, 8 * (most_dims or 0) * per))
    turns = [stored(ranked(sets.where(F.col("part").between(p, p + together - 1))), "top", HAND) for p in range(0, parts, together)]
    return reduce(DataFrame.unionByName, turns)

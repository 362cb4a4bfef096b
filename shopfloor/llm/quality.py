"""Operator 4: quality classifier on supervised subword embeddings.

Every word gives itself and its character n-grams as features, and how many words ago the text last had it, by powers of
two; all are hashed to rows of a learned table. A document is the mean of its rows; a softmax over two classes reads it. Embeddings and
softmax are trained together by stochastic gradient descent in numpy on a bounded sample of labelled documents.

The mean is linear, so a document's log-odds is the mean of one number per feature: embedding times the difference of
the two softmax rows. Scoring adds these up over every word of every text, with the distinct words of a slice of rows
looked at once; a task holds nothing from one slice to the next.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.llm import common

#: Labelled documents of each class that training takes at most, those with the least hash of doc_id. Their feature rows
#: all count, BUCKETS for each at most.
SAMPLE = 1000
#: Steps of training: as many rounds over the examples as make them, so that few examples are learnt as well as many.
STEPS = 16_000
BUCKETS, DIM, RATE, SEED = 1 << 16, 10, 0.1, 11
GRAMS = (3, 4, 5)
#: Documents with a smaller score are rejected.
KEEP = 0.3
#: Bytes of text that are worked on at once.
SLICE = 1 << 20
U64 = np.uint64


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


@dataclass
class Features:
    """Of some texts: the distinct word of each word in order and each text's number of words; feature rows of distinct
    words and whose they are; and for each word in order the row of when the text last had it."""

    which: np.ndarray
    counts: np.ndarray
    rows: np.ndarray
    owner: np.ndarray
    last: np.ndarray


def hashed(x: np.ndarray) -> np.ndarray:
    return (x % U64(BUCKETS)).astype(np.int64)


def features(column: pa.Array) -> Features:
    data, off = common.buffers(column)
    start, end, row = common.runs(data, off, common.SOLID)
    if not len(start):
        none = np.zeros(0, np.int64)
        return Features(none, np.zeros(len(column), np.int64), none, none, none)
    words = common.ByteHash(data).of(start, end)
    names, first, which = np.unique(words, return_index=True, return_inverse=True)
    # the distinct words between marks, one after another
    lens = (end - start)[first] + 2
    ends = np.cumsum(lens)
    own = np.repeat(np.arange(len(names)), lens)
    marked = data[np.clip(np.arange(ends[-1]) + np.repeat(start[first] - 1 - (ends - lens), lens), 0, len(data) - 1)]
    marked[ends - lens], marked[ends - 1] = 60, 62
    chars = np.flatnonzero((marked & 0xC0) != 0x80)
    bounds, own, grams = np.append(chars, len(marked)), own[chars], common.ByteHash(marked)
    rows, owner = [hashed(common.mix(names + U64(1)))], [np.arange(len(names))]
    for n in GRAMS:
        i = np.arange(max(0, len(chars) - n + 1))
        i = i[own[i] == own[i + n - 1]]
        rows.append(hashed(grams.of(bounds[i], bounds[i + n])))
        owner.append(own[i])
    order = np.lexsort((which, row))  # stable: a text's places of one word, in order
    again = (row[order[1:]] == row[order[:-1]]) & (which[order[1:]] == which[order[:-1]])
    ago = np.zeros(len(which), np.int64)
    ago[order[1:][again]] = (order[1:] - order[:-1])[again]
    last = hashed(common.mix(np.frexp(ago.astype(np.float64))[1].astype(U64) + U64(2)))
    return Features(which, np.bincount(row, minlength=len(column)), np.concatenate(rows), np.concatenate(owner), last)


def document_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct feature rows of a text and the share of each; the shares sum to 1, or there are none."""
    f = features(pa.array([text], pa.string()))
    times = np.bincount(f.which, minlength=int(f.owner.max(initial=-1)) + 1)
    ids, at = np.unique(np.concatenate([f.rows, f.last]), return_inverse=True)
    n = np.bincount(at, weights=np.concatenate([times[f.owner], np.ones(len(f.last))]), minlength=len(ids))
    return ids, n / max(1.0, n.sum())


class Model:
    """Log-odds of class 1 for each feature row, and the bias."""

    def __init__(self, odds: np.ndarray, bias: float):
        self.odds, self.bias = odds, bias


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], least: int = STEPS) -> Model:
    """Whole rounds over the examples, of ``least`` steps or more. Both classes weigh the same in total; without examples
    of both, every score is one half."""
    ones = sum(y for *_, y in examples)
    if not 0 < ones < len(examples):
        return Model(np.zeros(BUCKETS, np.float32), 0.0)
    rng = np.random.default_rng(SEED)
    table = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    soft = np.zeros((2, DIM), np.float32)
    bias = np.zeros(2, np.float32)
    weight = np.array([len(examples) / 2 / (len(examples) - ones), len(examples) / 2 / ones])
    weight = weight / weight.max()
    epochs = -(-least // len(examples))
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        for k in rng.permutation(len(examples)):
            ids, share, y = examples[k]
            rate = RATE * (1 - done / steps) * weight[y]
            done += 1
            share = share.astype(np.float32)
            mean = share @ table[ids]
            z = soft @ mean + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = p @ soft
            soft -= rate * np.outer(p, mean)
            bias -= rate * p
            # a mean over many features moves little; each row takes the step of its share of the largest
            table[ids] -= np.outer(share / max(share.max(initial=0), 1e-9), rate * back)
    return Model((table @ (soft[1] - soft[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Trains on at most ``sample`` documents of each class. Labels that are null, that disagree for one doc_id, or
    whose doc_id is held out or has no text row take no part; of rows that share a doc_id the least text is taken."""
    known = labels.where("doc_id is not null and quality in (0, 1)").where(~held_out()).groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("top")).where("y = top")
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    few = F.broadcast(picked[0].unionByName(picked[1]).select("doc_id", "y"))  # 2 * sample rows at most
    rows = docs.select("doc_id", "text").join(few, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [document_features(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), pa.array([x[0] for x in found], pa.list_(pa.int32())), pa.array([x[1] for x in found], pa.list_(pa.float32()))], names=["doc_id", "y", "ids", "share"])

    # 2 * sample rows of two lists of BUCKETS numbers at most
    found = rows.mapInArrow(taken, "doc_id bigint, y int, ids array<int>, share array<float>").toArrow().sort_by("doc_id").combine_chunks()
    if not found.num_rows:
        return train([])
    ids, share = (found.column(c).combine_chunks() for c in ("ids", "share"))
    bounds, ids, share = ids.offsets.to_numpy(), ids.values.to_numpy(), share.values.to_numpy()
    return train([(ids[a:b], share[a:b], int(y)) for a, b, y in zip(bounds[:-1], bounds[1:], found.column("y").to_numpy(), strict=True)])


def log_odds(column: pa.Array, odds: np.ndarray, bias: float) -> np.ndarray:
    """The log-odds of class 1 of each text."""
    f = features(column)
    n = len(f.counts)
    text = np.repeat(np.arange(n), f.counts)
    sums, sizes = np.bincount(f.owner, weights=odds[f.rows]), np.bincount(f.owner) + 1
    total, size = (np.bincount(text, weights=x, minlength=n) for x in (sums[f.which] + odds[f.last], sizes[f.which]))
    return total / np.maximum(size, 1) + bias


def score(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """Adds ``score`` (0 to 1, of class 1) and ``predicted`` (1 from ``keep`` on) to every row, from its text alone.
    Null texts and those without words have the bias's score. Columns of these names are replaced."""
    docs = docs.drop("score", "predicted")
    kind = docs.select("*", F.lit(0.0).alias("score")).schema
    odds, bias = model.odds, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for y in batches for x in common.slices(y, "text", SLICE)):
            z = log_odds(b.column("text"), odds, bias)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(1 / (1 + np.exp(-z)), pa.float64())], schema=pa.schema([*b.schema, pa.field("score", pa.float64())]))

    return docs.mapInArrow(run, kind).withColumn("predicted", (F.col("score") >= keep).cast("int"))

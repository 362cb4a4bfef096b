"""Operator 2: benchmark decontamination by BM25 over an inverted index of test items with block-max WAND.

Every training passage is a query: two strides of words in a row, so that each item lies whole in some passage. Document
frequencies and lengths are those of all items. Impacts are divided by the score that an item has as its own query, so 1
means all of its terms. A term's posting list is in blocks of items with the best impact of each. Of a passage's terms,
ordered by their best impact, those before the pivot weigh too little together to matter, so only the lists from the
pivot on are opened; blocks whose best impacts, with that little, miss the threshold are skipped; of the others all lists
are looked up, first their best impacts and then, if these still reach it, their postings. Every item over the threshold
is checked for overlap of the words of its question and of its answer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm import common

K1, B = 1.2, 0.75
#: Words of a stride at least, items of a block, and the share of an item's own score that is retrieved.
STRIDE, BLOCK, LEAST = 64, 8, 0.6
#: Words of the n-grams whose overlap is checked, and the share needed of question and of answer.
GRAM, OVERLAP = 4, 0.6
#: Postings and bytes of text of one part of the index, as the driver and each task hold it; a larger index has more
#: parts and takes a pass over the corpus for each. Scores do not depend on the parts.
POSTINGS, BYTES = 4 << 20, 32 << 20
#: Best impacts that the terms before a passage's pivot have together at most, and passages times blocks whose bounds are
#: held at once.
SLACK, CELLS = 0.1, 4 << 20


@dataclass
class Index:
    """Terms (sorted hashes), the best impact of each, and posting lists by term and block: entries (term * blocks +
    block, sorted) with their best impact and where their postings (item, impact) begin; and what the check needs."""

    ids: list
    terms: np.ndarray
    best: np.ndarray
    entries: np.ndarray
    entry_best: np.ndarray
    starts: np.ndarray
    item: np.ndarray
    impact: np.ndarray
    blocks: int
    parts: list[tuple[np.ndarray, np.ndarray]]
    stride: int


def question_and_answer(text: str) -> tuple[str, str]:
    """The answer is the last line, or of a single line the last sentence; a lone sentence is a question."""
    cuts = [m.end() for m in re.finditer(r"\n(?=.*\w)" if re.search(r"\w.*\n.*\w", text, re.S) else r"[.!?] (?=.*\w)", text)]
    return (text[: cuts[-1]], text[cuts[-1] :]) if cuts else (text, "")


def hashed_words(text: str) -> np.ndarray:
    return common.word_hashes(pa.array([text]), common.ALNUM)[0]


def grams(words: np.ndarray) -> np.ndarray:
    return np.unique(common.shingles(words, min(GRAM, max(1, len(words)))))


def impacts(items: DataFrame) -> tuple[DataFrame, int]:
    """no, item_id, text, words (how many), terms and impacts of every item that has words, as a stored table, and the
    words of a stride: as many as the longest item has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.unique(hashed_words(t.as_py() or ""), return_counts=True) for t in b.column("text")]
            lists = [pa.array([x[k] for x in found], pa.list_(t)) for k, t in ((0, pa.uint64()), (1, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([int(x[1].sum()) for x in found], pa.int64()), lists[0].cast(pa.list_(pa.int64()), safe=False), lists[1]], names=["no", "item_id", "text", "words", "terms", "times"])

    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").withColumn("no", F.monotonically_increasing_id()).select("no", "item_id", "text")
    rows = common.stored(rows.mapInArrow(count, "no bigint, item_id bigint, text string, words bigint, terms array<bigint>, times array<int>").where("words > 0"), "items")
    n, mean, most = rows.select(F.count("*"), F.avg("words"), F.max("words")).first()
    each = rows.select("no", "words", F.explode(F.arrays_zip("terms", "times")).alias("t")).select("no", "words", F.col("t.terms").alias("term"), F.col("t.times").alias("f"))
    df = common.stored(each.groupBy("term").agg(F.count("*").alias("df")), "frequencies")
    idf, f = F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)), F.col("f")
    one = idf * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("words") / F.lit(mean)))
    own = each.join(df, "term").withColumn("impact", one).groupBy("no").agg(F.array_sort(F.collect_list(F.struct("term", "impact"))).alias("p"), F.sum("impact").alias("whole"))
    out = own.select("no", F.col("p.term").alias("terms"), F.transform("p.impact", lambda x: (x / F.col("whole")).cast("float")).alias("impacts"))
    return common.stored(rows.select("no", "item_id", "text", "words").join(out, "no"), "impacts"), max(STRIDE, most or 0)


def build(items: pa.Table, stride: int) -> Index | None:
    """The index of some items, as ``impacts`` gives them."""
    if not items.num_rows:
        return None
    items = items.sort_by([("words", "ascending"), ("text", "ascending"), ("no", "ascending")]).combine_chunks()  # alike lengths share blocks
    sizes = items.column("terms").combine_chunks().value_lengths().to_numpy().astype(np.int64)
    hashes = items.column("terms").combine_chunks().flatten().to_numpy().view(np.uint64)
    impact, item = items.column("impacts").combine_chunks().flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
    terms, of = np.unique(hashes, return_inverse=True)
    blocks = -(-len(sizes) // BLOCK)
    order = np.lexsort((item, of))
    of, item, impact = of[order], item[order], impact[order]
    entries, starts = np.unique(of * blocks + item // BLOCK, return_index=True)
    entry_best = np.maximum.reduceat(impact, starts)
    best = np.zeros(len(terms), np.float32)
    np.maximum.at(best, entries // blocks, entry_best)
    parts = [tuple(hashed_words(p) for p in question_and_answer(t)) for t in items.column("text").to_pylist()]
    return Index(items.column("item_id").to_pylist(), terms, best, entries, entry_best, np.append(starts, len(item)), item, impact, blocks, parts, stride)


def overlap(part: np.ndarray, passage: np.ndarray) -> float:
    """Share of a part's n-grams that the passage has; 1 for an empty part."""
    if not len(part):
        return 1.0
    n = min(GRAM, len(part))
    return float(np.isin(grams(part), common.shingles(passage, n)).mean())


def search(words: np.ndarray, counts: np.ndarray, index: Index, least: float = LEAST) -> list[tuple[int, int, int, float]]:
    """(row, first word of the passage, item, score) of every passage and item that reach the threshold."""
    stride, n_terms = index.stride, len(index.terms)
    row = np.repeat(np.arange(len(counts)), counts)
    inside = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    strides = -(-counts // stride)
    first = np.cumsum(strides) - strides  # stride numbers run on over all rows
    term = np.minimum(np.searchsorted(index.terms, words), n_terms - 1)
    known = index.terms[term] == words
    where, term = first[row[known]] + inside[known] // stride, term[known]
    before = inside[known] >= stride  # a word is in the passage that begins with its stride and in the one before
    pairs = np.unique(np.concatenate([where, where[before] - 1]) * n_terms + np.concatenate([term, term[before]]))
    where, term = np.divmod(pairs, n_terms)
    order = np.lexsort((index.best[term], where))
    where, term = where[order], term[order]
    best = index.best[term].astype(np.float64)
    sums = np.cumsum(best)
    fresh = np.concatenate([[True], where[1:] != where[:-1]]) if len(where) else np.zeros(0, bool)
    if not len(where):
        return []
    starts = np.flatnonzero(fresh)
    own = np.cumsum(fresh) - 1
    sums = sums - (sums - best)[starts][own]
    least -= 1e-4  # sums of bounds and of postings round apart
    opened = sums >= SLACK  # from the pivot on
    rest = np.zeros(len(starts))
    np.maximum.at(rest, own[~opened], sums[~opened])
    able = sums[np.append(starts[1:], len(where)) - 1] >= least
    owner, sizes = np.repeat(np.arange(len(counts)), strides), np.diff(np.append(starts, len(where)))
    lists, out = np.searchsorted(index.entries, np.arange(n_terms + 1) * index.blocks), []
    at_once = max(1, CELLS // index.blocks)
    for low in range(0, len(starts), at_once):
        n = min(at_once, len(starts) - low)
        mine = np.flatnonzero((opened & able[own])[starts[low] : starts[low + n - 1] + sizes[low + n - 1]]) + starts[low]
        which, entry = expand(lists[term[mine]], lists[term[mine] + 1])
        cell = (own[mine] - low)[which] * index.blocks + index.entries[entry] % index.blocks
        bound = np.bincount(cell, weights=index.entry_best[entry], minlength=n * index.blocks).reshape(n, index.blocks)
        p, k = np.nonzero(bound >= np.maximum(least - rest[low : low + n, None], 1e-9))
        p += low
        which, at = expand(starts[p], starts[p] + sizes[p])
        key = term[at] * index.blocks + k[which]
        e = np.minimum(np.searchsorted(index.entries, key), len(index.entries) - 1)
        hit = index.entries[e] == key
        which, e = which[hit], e[hit]
        some = (np.bincount(which, weights=index.entry_best[e], minlength=len(p)) >= least)[which]
        which, e = which[some], e[some]
        by, at = expand(index.starts[e], index.starts[e + 1])
        place = which[by] * BLOCK + index.item[at] - k[which[by]] * BLOCK
        scores = np.bincount(place, weights=index.impact[at], minlength=len(p) * BLOCK)
        for x in np.flatnonzero(scores >= least).tolist():
            a = int(where[starts[p[x // BLOCK]]])
            out.append((int(owner[a]), int(a - first[owner[a]]) * stride, int(k[x // BLOCK]) * BLOCK + x % BLOCK, float(scores[x])))
    return out


def expand(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from each start to before its end, and which range each is of."""
    size = end - start
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) + np.repeat(start - (np.cumsum(size) - size), size)


def indexes(items: DataFrame) -> Iterator[Index]:
    """Every item in some part of the index; an item beyond the bounds has one to itself."""
    rows, stride = impacts(items)
    n, size = rows.select(F.coalesce(F.sum(F.size("terms")), F.lit(0)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    shards = max(1, -(-n // POSTINGS), -(-size // BYTES))
    for k in range(shards):
        made = build(rows.where(F.pmod(F.xxhash64("no"), F.lit(shards)) == k).toArrow(), stride)
        if made:
            yield made


PAIRS = "doc_id bigint, row_key bigint, item_id bigint, score double, first_word bigint, question double, answer double"


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """A row per document and item whose overlap is confirmed: doc_id, row_key, item_id, score, first_word (of the
    passage that scores best), question and answer (shares of their n-grams).

    Null and empty texts hold nothing; items without words are never found; repeated rows and items each give rows. Null
    ids stay null. Other columns are not read. Without items the result is empty.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), common.text_key().alias("row_key"), "text")
    found = None
    for index in indexes(items):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for b in (x for y in batches for x in common.slices(y, "text", 1 << 20)):
                words, counts = common.word_hashes(b.column("text"), common.ALNUM)
                starts = np.cumsum(counts) - counts
                best: dict[tuple[int, int], tuple] = {}
                for row, at, item, score in search(words, counts, index):
                    passage = words[starts[row] + at : starts[row] + min(counts[row], at + 2 * index.stride)]
                    q, a = (overlap(p, passage) for p in index.parts[item])
                    if q >= OVERLAP and a >= OVERLAP:
                        best[row, item] = max(best.get((row, item), (0.0,)), (score, -at, q, a))
                keys = list(best)
                at = pa.array([r for r, _ in keys], pa.int64())
                score, first, q, a = (list(c) for c in zip(*best.values(), strict=True)) if best else ([], [], [], [])
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(at), b.column("row_key").take(at), pa.array([index.ids[i] for _, i in keys], pa.int64()), pa.array(score, pa.float64()), pa.array([-f for f in first], pa.int64()), pa.array(q, pa.float64()), pa.array(a, pa.float64())], names=["doc_id", "row_key", "item_id", "score", "first_word", "question", "answer"])

        own = rows.mapInArrow(run, PAIRS)
        found = own if found is None else found.unionByName(own)
    return found if found is not None else docs.sparkSession.createDataFrame([], PAIRS)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a confirmed item, as they are, with all their columns."""
    own, key = common.fresh(docs, 2)
    bad = contaminated(docs, items).select(F.col("doc_id").alias(own), F.col("row_key").alias(key)).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(own)) & (common.text_key() == F.col(key)), "left_anti")

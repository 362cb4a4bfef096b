"""Operator 11: which tokens of two tokenizers stand for the same bytes, and how often over the corpus.

Two tokens of a text are linked where their byte ranges overlap. The pairs of a slice of documents are counted by
document and dealt by their B id to runs, sorted by B and then A and compressed with zstd. Rounds of k-way heap merges
count each pair over the corpus; in a merged run all pairs of a B id stand together, which gives their highest count.
Counts and maxima then go back, run by run, to the slices that the pairs came from. Only runs meet, never the pairs of
documents, so a pair that is everywhere has one record a slice.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm import common, tokens

BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Runs that a slice's pairs are dealt to, about as many runs as one task merges, and pairs that a run decodes at once.
RADIX, FAN, CHUNK = 128, 64, 1 << 16
SLICE = 4 << 20
BIT = 20  # of an A id in a pair's number


class Plain(tokens.Encoder):
    """The byte-level tokenizer, to which the strings of special tokens are text like any other."""

    def __init__(self, path: str):
        super().__init__(path)
        self.library.encode_special_tokens = True
        self.added = re.compile("(?!)")


def flat(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(pieces), np.uint8), np.concatenate([[0], np.cumsum([len(p) for p in pieces])])


def byte_alphabet() -> dict[str, int]:
    """The byte of each character that byte-level vocabularies write for one."""
    return {sign: b for b, sign in enumerate(tokens.SIGNS)}


@functools.lru_cache(maxsize=1)
def both(a: str, b: str):
    """The two encoders, and the bytes of each one's ids in one array with their bounds; one of each per worker."""
    import sentencepiece

    place = lambda v: v if "/" in v else tokens.public_path(v)
    one, two = Plain(place(a)), sentencepiece.SentencePieceProcessor(model_file=place(b))
    letter = byte_alphabet()
    known = {i: t for t, i in one.library.get_vocab(with_added_tokens=True).items()}
    raw = [bytes(letter[c] for c in t) if (t := known.get(i, "")) and all(c in letter for c in t) else t.encode() for i in range(max(known) + 1)]
    said = [bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode() for i in range(two.get_piece_size())]
    return one, two, flat(raw), flat(said)


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of ranges, one after another."""
    off = np.concatenate([[0], np.cumsum(size)])
    return np.repeat(start - off[:-1], size) + np.arange(off[-1])


def equal(ids: np.ndarray, counts: np.ndarray, table, data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Whether the bytes of each text's ids are its own."""
    size = np.diff(table[1])[ids]
    bounds = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
    same = np.diff(bounds) == np.diff(off)
    kept = np.repeat(same, counts)
    made, given = table[0][ranges(table[1][ids[kept]], size[kept])], data[np.repeat(same, np.diff(off))]
    wrong = np.concatenate([[0], np.cumsum(made != given)])
    ends = np.concatenate([[0], np.cumsum(np.diff(off)[same])])
    same[same] = np.diff(wrong[ends]) == 0
    return same


DIGITS = np.zeros((1 << 17, 7), np.uint8)
for _k in range(6):
    _d = np.arange(len(DIGITS)) // 10 ** (5 - _k)
    DIGITS[:, _k] = np.where((_d > 0) | (_k == 5), 48 + _d % 10, 0)


class Aligned:
    """The groups and links of some texts."""

    def __init__(self, texts: list[str], a: str = BYTES, b: str = PIECES):
        one, two, raw, said = both(a, b)
        n = len(texts)
        spaced = [(" " + t).encode() if t else b"" for t in texts]
        data, off = flat(spaced)
        ids_a, n_a = one.encode([" " + t if t else "" for t in texts])
        found = two.encode([t or "" for t in texts], num_threads=1)
        n_b = np.fromiter(map(len, found), np.int64, n)
        ids_b = np.fromiter((i for f in found for i in f), np.int64, int(n_b.sum()))
        ids_a = ids_a.astype(np.int64)
        good = equal(ids_a, n_a, raw, data, off) & equal(ids_b, n_b, said, data, off) & (np.diff(off) > 0)
        ids_a, ids_b = ids_a[np.repeat(good, n_a)], ids_b[np.repeat(good, n_b)]
        self.n_a, self.n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        end_a, end_b = np.cumsum(np.diff(raw[1])[ids_a]), np.cumsum(np.diff(said[1])[ids_b])
        total = int(end_a[-1]) if len(end_a) else 0
        is_a, is_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        is_a[end_a], is_b[end_b] = True, True
        common_end = is_a & is_b
        ends = np.concatenate([[0], np.cumsum(np.where(good, np.diff(off), 0))])  # of each text
        group = np.cumsum(common_end)
        self.n_groups = np.diff(np.concatenate([[0], group])[ends + 1]) if total else np.zeros(n, np.int64)
        # every stretch between two ends next to each other is the overlap of one token with one other
        link = np.flatnonzero(is_a | is_b)
        self.n_links = np.diff(np.searchsorted(link, ends, "right"))
        of_a, of_b = ids_a[np.cumsum(is_a)[link - 1]], ids_b[np.cumsum(is_b)[link - 1]]
        pair = ((of_b % RADIX) << (2 * BIT + 3)) | (of_b << BIT) | of_a
        #: The pairs of all texts in order of run, B and A, how often each is linked, and by text which and how often.
        self.pairs, at, self.counts = np.unique(pair, return_inverse=True, return_counts=True)
        own, self.times = np.unique(np.repeat(np.arange(n), self.n_links) * max(1, len(self.pairs)) + at, return_counts=True)
        self.text, self.which = np.divmod(own, max(1, len(self.pairs)))
        self.sha = self._digests(ids_a, ids_b, end_a, end_b, group, common_end)

    def _digests(self, ids_a, ids_b, end_a, end_b, group, common_end) -> list[str]:
        if not len(ids_a):
            return [""] * len(self.n_a)
        group_a, group_b, groups = group[end_a - 1], group[end_b - 1], int(group[-1])
        before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=groups))])
        upto_a = np.cumsum(np.bincount(group_a, minlength=groups))
        put_a, put_b = np.arange(len(ids_a)) + before_b[group_a], np.arange(len(ids_b)) + upto_a[group_b]
        rows = np.zeros((len(ids_a) + len(ids_b), 7), np.uint8)
        rows[put_a], rows[put_b] = DIGITS[ids_a], DIGITS[ids_b]
        rows[put_a, 6] = np.where(common_end[end_a], ord("|"), ord(","))
        rows[put_b, 6] = np.where(common_end[end_b], ord(";"), ord(","))
        tokens_end = np.cumsum(self.n_a + self.n_b)
        rows[tokens_end[self.n_b > 0] - 1, 6] = 0
        off = np.concatenate([[0], np.cumsum((rows != 0).sum(1))])[np.concatenate([[0], tokens_end])]
        said = memoryview(rows.ravel()[rows.ravel() != 0])
        return [hashlib.sha256(said[off[k] : off[k + 1]]).hexdigest() if off[k + 1] > off[k] else "" for k in range(len(self.n_a))]


def packed(values: np.ndarray) -> bytes:
    """Whole numbers, byte planes apart, by zstd."""
    return zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(values, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(np.int64).ravel()


def rising(values: np.ndarray) -> bytes:
    return packed(np.diff(values, prepend=0))


def run(keys: np.ndarray, counts: np.ndarray) -> list[dict]:
    """A sorted run as chunks, each decoded by itself."""
    return [{"keys": rising(keys[k : k + CHUNK]), "counts": packed(counts[k : k + CHUNK])} for k in range(0, len(keys), CHUNK)]


def chunks(blobs) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for c in blobs:
        yield np.cumsum(unpacked(c["keys"])), unpacked(c["counts"])


def merged(runs: list[Iterator[tuple[np.ndarray, np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """One run of several: the heap has each run's open chunk by its last key, and all keys up to the least of these are
    added up at once. A chunk of each run is open at a time."""
    open_, heap = {}, []

    def next_of(k: int) -> None:
        chunk = next(runs[k], None)
        if chunk is not None:
            open_[k] = chunk
            heapq.heappush(heap, (int(chunk[0][-1]), k))

    for k in range(len(runs)):
        next_of(k)
    while heap:
        bound, done, keys, counts = heap[0][0], [], [], []
        while heap and heap[0][0] == bound:
            done.append(heapq.heappop(heap)[1])
        for k, (own, n) in list(open_.items()):
            cut = int(np.searchsorted(own, bound, "right"))
            keys.append(own[:cut])
            counts.append(n[:cut])
            if cut == len(own):
                del open_[k]
            else:
                open_[k] = (own[cut:], n[cut:])
        keys, counts = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(keys, kind="stable")
        keys, start = np.unique(keys[order], return_index=True)
        yield keys, np.add.reduceat(counts[order], start)
        for k in done:
            next_of(k)


RUN = "array<struct<keys:binary,counts:binary>>"
DOCS = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
DOC_TYPES = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string())]
RUN_TYPE = pa.list_(pa.struct([("keys", pa.binary()), ("counts", pa.binary())]))
OUT = pa.schema([*DOC_TYPES, ("n_best", pa.int64()), ("count_sum", pa.int64())])


BACK = "slice bigint, radix int, size bigint, counts binary, best binary"
BACK_TYPES = pa.schema([("slice", pa.int64()), ("radix", pa.int32()), ("size", pa.int64()), ("counts", pa.binary()), ("best", pa.binary())])


def sliced(docs: DataFrame, a: str, b: str) -> DataFrame:
    """A row for each slice of documents, with its documents and by document the pairs as places in the slice's; and a row
    for each of its runs."""
    doc_rows = pa.list_(pa.struct(DOC_TYPES))
    schema = pa.schema([("slice", pa.int64()), ("radix", pa.int32()), ("docs", doc_rows), ("text", pa.binary()), ("which", pa.binary()), ("times", pa.binary()), ("run", RUN_TYPE)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in (part for x in batches for part in common.slices(x, "text", SLICE)):
            found = Aligned(batch.column("text").to_pylist(), a, b)
            rows = pa.StructArray.from_arrays([batch.column("doc_id"), *map(pa.array, (found.n_a, found.n_b, found.n_groups, found.n_links)), pa.array(found.sha, pa.string())], names=[n for n, _ in DOC_TYPES])
            radix = found.pairs >> (2 * BIT + 3)
            at = np.searchsorted(radix, np.arange(RADIX + 1))
            full = np.flatnonzero(np.diff(at))
            out = [{"slice": number, "radix": -1, "docs": rows.to_pylist(), "text": rising(found.text), "which": packed(np.diff(found.which, prepend=0)), "times": packed(found.times)}]
            out += [{"slice": number, "radix": int(r), "run": run(found.pairs[at[r] : at[r + 1]], found.counts[at[r] : at[r + 1]])} for r in full]
            yield pa.RecordBatch.from_pylist(out, schema=schema)
            number += 1

    kinds = f"slice bigint, radix int, docs array<struct<{DOCS.replace(' ', ':').replace(',:', ',')}>>, text binary, which binary, times binary, run {RUN}"
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(cut, kinds)


def merge_runs(key: tuple, table: pa.Table) -> pa.Table:
    blobs = []
    for keys, counts in merged([chunks(r) for r in table.column("run").to_pylist()]):
        blobs += run(keys, counts)
    return pa.table({"radix": [key[0].as_py()], "part": [key[1].as_py()], "run": pa.array([blobs], RUN_TYPE)}, schema=pa.schema([("radix", pa.int32()), ("part", pa.int64()), ("run", RUN_TYPE)]))


def give_back(slices: pa.Table, total: pa.Table) -> pa.Table:
    """For each pair of the slices' runs its count over the corpus, and whether that is its B id's highest."""
    if not slices.num_rows:  # a part that no slice of this run is in
        return BACK_TYPES.empty_table()
    known = list(chunks(total.column("run")[0].as_py()))
    keys, counts = np.concatenate([k for k, _ in known]), np.concatenate([c for _, c in known])
    side = keys >> BIT
    start = np.flatnonzero(np.diff(side, prepend=-1))
    best = counts == np.repeat(np.maximum.reduceat(counts, start), np.diff(np.append(start, len(side))))
    counted, highest = [], []
    for blobs in slices.column("run").to_pylist():
        at = np.searchsorted(keys, np.concatenate([k for k, _ in chunks(blobs)]))
        counted.append(packed(counts[at]))
        highest.append(np.packbits(best[at]).tobytes())
    return pa.table({"slice": slices.column("slice"), "radix": slices.column("radix"), "size": pa.array([sum(len(k) for k, _ in chunks(b)) for b in slices.column("run").to_pylist()], pa.int64()), "counts": pa.array(counted, pa.binary()), "best": pa.array(highest, pa.binary())}, schema=BACK_TYPES)


def summed(docs: pa.Table, back: pa.Table) -> pa.Table:
    """The slice's documents with the sums over their links."""
    rows = sorted(zip(*(back.column(c).to_pylist() for c in ("radix", "size", "counts", "best")), strict=True))
    counts = np.concatenate([np.zeros(0, np.int64), *(unpacked(c) for _, _, c, _ in rows)])
    best = np.concatenate([np.zeros(0, bool), *(np.unpackbits(np.frombuffer(b, np.uint8))[:n].astype(bool) for _, n, _, b in rows)])
    one = docs.slice(0, 1).to_pylist()[0]
    text, which, times = np.cumsum(unpacked(one["text"])), np.cumsum(unpacked(one["which"])), unpacked(one["times"])
    n_best, total = np.zeros(len(one["docs"]), np.int64), np.zeros(len(one["docs"]), np.int64)
    np.add.at(n_best, text, times * best[which])
    np.add.at(total, text, times * counts[which])
    out = pa.Table.from_pylist(one["docs"], schema=pa.schema(DOC_TYPES))
    return out.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(total)).cast(OUT)


def alignments(docs: DataFrame, a: str = BYTES, b: str = PIECES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum of each row.

    Memory is that of a slice of 4 MB of text (or one longer text) with its tokens, of a chunk of each run in a merge, and
    of one merged run, which has no more pairs than the vocabularies allow. Null and empty texts, and those that a
    tokenizer doesn't give back byte by byte, have zeros and no digest. Repeated rows are rows each, and count as often;
    a null doc_id stays null; an empty table gives none. Other columns are not read.
    """
    made = common.stored(sliced(docs, a, b), "aligned")
    slices = made.where("radix >= 0").select("slice", "radix", "run")
    parts = max(1, -(-made.where("radix < 0").count() // FAN))
    part = lambda n: F.pmod(F.xxhash64("slice"), F.lit(n))
    level, n = slices.withColumn("part", part(parts)), parts
    while True:
        level = level.groupBy("radix", "part").applyInArrow(merge_runs, f"radix int, part bigint, run {RUN}")
        if n == 1:
            break
        n = -(-n // FAN)
        level = level.withColumn("part", F.pmod("part", F.lit(n)))
    total = common.stored(level.select("radix", "run"), "pairs")
    every = total.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))
    back = slices.withColumn("part", part(parts)).groupBy("radix", "part").cogroup(every.groupBy("radix", "part")).applyInArrow(give_back, BACK)
    own = made.where("radix < 0").select("slice", "docs", "text", "which", "times")
    return own.groupBy("slice").cogroup(back.groupBy("slice")).applyInArrow(summed, f"{DOCS}, n_best bigint, count_sum bigint")

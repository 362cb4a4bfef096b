"""Operator 10: removal of repeated 400-byte strings by a distributed difference-cover suffix sort.

Texts are cut into phrases at anchors, the minimisers of their byte grams, so equal strings are cut alike; a phrase's name
is the hash of its bytes up to the end of the next anchor's gram. A repeated string holds phrases of INSIDE bytes or more
in a row. Only suffixes that begin with such a row that is somewhere else too are sorted, all of them, copies included;
nothing that can match is left out.

The sort is a difference cover of the phrases: suffixes at positions 1 and 2 modulo 3 are the sample. The triples of their
names are sorted and named by rank, and these names stand for the sample's suffixes; where few phrases are too short to
reach over LENGTH bytes, triples of the names are named in turn, and so on. Then any two suffixes have a distance of 0, 1
or 2 phrases after which both are in the sample, so three sorts, each of two classes of positions, merge them all: by the
phrases before, then by the sample's names. Next to each other in some sort, suffixes have the longest prefix in common
that they share with any, to two phrases; a prefix of LENGTH bytes or more is a match. Windows that such prefixes do not
settle, near the first and last phrase of a match, are compared by a hash of their bytes, with all windows that begin
before the same phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm import common

LENGTH = 400
#: Bytes of a gram, and grams of which one at least is an anchor.
GRAM, SPREAD = 8, 120
#: Bytes of whole phrases that every repeated window holds; no phrase has as many.
INSIDE = LENGTH - 2 * SPREAD - GRAM
#: Names of the sample in a key of the three sorts, and levels of names of names at most: 3**6 phrases, of a byte or more.
KEYS, LEVELS = 4, 6
#: Phrases and bytes of text that Python works on at once, and texts that Spark hands it.
PHRASES, BYTES, HANDED = 1 << 15, 1 << 18, 512
#: Bits of a name: its level, the partition that gave it, and its number there.
LEVEL_AT, PART_AT = 58, 36
U64 = np.uint64


def anchors(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Positions of grams that are the least, and the first such, of some SPREAD grams in a row inside one text."""
    n = len(data) - GRAM + 1
    if n < SPREAD:
        return np.zeros(0, np.int64)
    low = U64((1 << max(20, n.bit_length())) - 1)
    grams, raw = np.empty(n, U64), data.tobytes()
    for k in range(min(GRAM, n)):
        grams[k::GRAM] = np.frombuffer(raw, "<u8", count=(len(raw) - k) // GRAM, offset=k)
    least = (common.mix(grams * U64(common.BASE)) & ~low) | np.arange(n, dtype=U64)
    size = 1
    while size * 2 <= SPREAD:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    least = np.minimum(least[: n - SPREAD + 1], least[SPREAD - size :])
    starts = np.arange(n - SPREAD + 1)
    inside = starts + SPREAD + GRAM - 1 <= np.repeat(off[1:], np.diff(off))[starts]
    found = (least[inside] & low).astype(np.int64)  # never falls
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and key, the same for texts that are the same."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))


def phrases(rows: DataFrame) -> DataFrame:
    """key, at (anchors' positions), names (one fewer) and rows (of each phrase, the hash of INSIDE bytes or more of phrases
    from it on, 0 if there are not so many) of texts of LENGTH bytes or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for y in batches for x in common.slices(y, "text", BYTES)):
            data, off = common.buffers(b.column("text"))
            hashes, found = common.ByteHash(data), anchors(data, off)
            row = np.searchsorted(off, found, "right") - 1
            counts = np.bincount(row, minlength=b.num_rows)
            inner = row[1:] == row[:-1] if len(row) else np.zeros(0, bool)
            first, last = found[:-1][inner], found[1:][inner] + GRAM
            far = np.minimum(np.searchsorted(found, first + INSIDE - GRAM), max(len(found) - 1, 0))
            whole = row[far] == row[:-1][inner]
            whole &= found[far] + GRAM - first >= INSIDE
            held = np.where(whole, hashes.of(first, np.where(whole, found[far] + GRAM, first)), U64(0))
            place = (found - off[row]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), common.lists(place, counts, pa.int32()), *(common.lists(x.view(np.int64), np.maximum(counts - 1, 0), pa.int64()) for x in (hashes.of(first, last), held))],
                names=["key", "at", "names", "rows"],
            )

    return rows.where(F.octet_length("text") >= LENGTH).select("key", "text").mapInArrow(run, "key bigint, at array<int>, names array<bigint>, rows array<bigint>")


def repeated(found: DataFrame) -> DataFrame:
    """key, at, names and own (j, the number of a phrase, and row) of texts with rows of phrases that are somewhere else
    too, as a stored table."""
    each = found.select("key", F.posexplode("rows").alias("j", "row")).where("row <> 0")
    # stored, so that both sides of the join are plain shuffles and a hot row can be split
    often = common.stored(each.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row"), "often")
    own = each.join(often, "row", "left_semi").groupBy("key").agg(F.collect_list(F.struct("j", "row")).alias("own"))
    out = common.stored(own.join(found.select("key", "at", "names"), "key"), "repeated")
    common.release(often)
    return out


@dataclass
class Runs:
    """The phrases that rows of repeated phrases cover, and SPREAD bytes more, of all texts of a batch: text, j, position in
    ``names``, and the position after the last of each one's run; ``own`` tells which begin such a row, ``rows`` its hash."""

    text: np.ndarray
    j: np.ndarray
    at: np.ndarray
    end: np.ndarray
    own: np.ndarray
    rows: np.ndarray
    names: np.ndarray
    places: np.ndarray
    first: np.ndarray

    def place(self, at: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Where in its text a phrase begins, or the last of a text ends but for its gram."""
        return self.places[at + text]

    def spread(self, values: np.ndarray, j: np.ndarray, text: np.ndarray, kind: type = np.int64) -> np.ndarray:
        """``values`` of some phrases, in the order of names; 0 for others."""
        out = np.zeros(len(self.names) + 1, kind)
        out[self.first[text] + j] = values
        return out


def flat(b: pa.RecordBatch, column: str) -> tuple[pa.Array, np.ndarray]:
    """The values of a list column, and the text of each."""
    lists = b.column(column)
    return lists.flatten(), np.repeat(np.arange(b.num_rows), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of batches with about PHRASES phrases each, one text at least."""
    for b in batches:
        off = np.concatenate([[0], np.cumsum(b.column("names").value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))])
        at = 0
        while at < b.num_rows:
            end = max(at + 1, int(np.searchsorted(off, off[at] + PHRASES, "right")) - 1)
            yield b.slice(at, min(end, b.num_rows) - at)
            at = end


def runs_of(b: pa.RecordBatch) -> Runs:
    names, of = flat(b, "names")
    names, places = names.to_numpy(), flat(b, "at")[0].to_numpy().astype(np.int64)
    first = np.searchsorted(of, np.arange(b.num_rows))
    own, text = flat(b, "own")
    g = first[text] + own.field("j").to_numpy()
    order = np.argsort(g, kind="stable")
    g, text, rows = g[order], text[order], own.field("row").to_numpy()[order]
    # a match may go on for less than SPREAD bytes after its last whole row
    wide, counts = np.int64(1) << 40, np.bincount(of, minlength=b.num_rows)
    ends = np.searchsorted(places + np.repeat(np.arange(b.num_rows), counts + 1) * wide, places[g + text] + INSIDE - GRAM + SPREAD + text * wide) - text
    ends = np.minimum(ends, (first + counts)[text])
    cover = np.zeros(len(names) + 1, np.int64)
    np.add.at(cover, g, 1)
    np.add.at(cover, ends, -1)
    at = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
    owner = of[at]
    fresh = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1])]) if len(at) else np.zeros(0, bool)
    run_ends = at[np.append(np.flatnonzero(fresh)[1:] - 1, len(at) - 1)] + 1 if len(at) else at
    is_own, held = np.zeros(len(names) + 1, bool), np.zeros(len(names) + 1, np.int64)
    is_own[g], held[g] = True, rows
    return Runs(owner, at - first[owner], at, run_ends[np.cumsum(fresh) - 1] if len(at) else at, is_own[at], held[at], names, places, first)


def ahead(values: np.ndarray, at: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
    """The value k phrases on, 0 beyond the run."""
    return np.where(at + k < end, values[np.minimum(at + k, len(values) - 1)], 0)


def levels(r: Runs) -> tuple[np.ndarray, list[np.ndarray]]:
    """The level of names that a sample phrase needs beyond its keys to reach LENGTH bytes or its run's end, 0 if none; and
    by level from 1 on which phrases must be named for that."""
    start, need = r.place(r.at, r.text), np.zeros(len(r.at), np.int64)
    reached = lambda k: (r.at + k >= r.end) | (r.place(np.minimum(r.at + k, r.end), r.text) + GRAM - start >= LENGTH)
    short = (r.j % 3 > 0) & ~reached(3 * KEYS)
    for level in range(LEVELS - 1, 1, -1):
        need[short & reached(3 ** (level + 1))] = level
    wanted, later = [], np.zeros(len(r.at), bool)
    for level in range(LEVELS - 1, 0, -1):
        named = later | (need == level)
        wanted.insert(0, named)
        on = np.zeros(len(r.names) + 1, bool)
        for d in range(3):
            k = r.at[named] + d * 3**level
            on[k[k < r.end[named]]] = True
        later = on[r.at]
    return need, wanted


def triples(own: DataFrame, level: int) -> DataFrame:
    """key, j, and the triple a, b, c of the sample's names of the level before (of phrases at level 0)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            r = runs_of(b)
            if level:
                found, text = flat(b, "t")
                values, pick = r.spread(found.field("name").to_numpy(), found.field("j").to_numpy(), text), levels(r)[1][level - 1]
            else:
                values, pick = np.append(r.names, 0), r.j % 3 > 0
            cols = [ahead(values, r.at[pick], r.end[pick], k * 3**level) for k in range(3)]
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(r.text[pick])), pa.array(r.j[pick].astype(np.int32)), *map(pa.array, cols)], names=["key", "j", "a", "b", "c"])

    return own.mapInArrow(run, "key bigint, j int, a bigint, b bigint, c bigint")


def edges_of(table: DataFrame) -> list[list[int]]:
    """The first and the last row of each sorted partition, two for each: partition, whether it is the last, and values."""
    return sorted(r.edge for r in table.where("edge is not null").select("edge").collect())


def meetings(edges: list[list[int]]) -> Iterator[tuple[list[int], list[int]]]:
    """The last row of each partition with the first of the one after it."""
    return ((a[2:], b[2:]) for a, b in zip(edges[1::2], edges[2::2], strict=False))


def batch(names: list[str], **columns) -> pa.RecordBatch:
    kinds = {"key": pa.int64(), "j": pa.int32(), "name": pa.int64(), "most": pa.int64(), "edge": pa.list_(pa.int64())}
    n = max(len(c) for c in columns.values())
    return pa.RecordBatch.from_arrays([pa.array(columns[c], kinds[c]) if c in columns else pa.nulls(n, kinds[c]) for c in names], names=names)


def named(rows: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """key, j and name: the rank of each triple a, b, c among all, the same for equal ones, and the stored table it is of.

    Ties are split by key and j, so no partition has to hold all copies of a suffix; a name that runs on over the end of
    a partition becomes that of its first.
    """
    by, columns = ["a", "b", "c"], ["key", "j", "name", "edge"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        name = ((level + 1) << LEVEL_AT) | (part << PART_AT)
        for b in (x for x in batches if x.num_rows):
            v = np.stack([b.column(c).to_numpy() for c in by])
            new = np.ones(v.shape[1], bool)
            new[1:] = (v[:, 1:] != v[:, :-1]).any(0)
            new[0] = last is None or bool((v[:, 0] != last).any())
            found = name + np.cumsum(new)
            if last is None:
                yield batch(columns, edge=[[part, 0, int(found[0]), *v[:, 0].tolist()]])
            yield batch(columns, key=b.column("key"), j=b.column("j"), name=found)
            name, last = int(found[-1]), v[:, -1]
        if last is not None:
            yield batch(columns, edge=[[part, 1, name, *last.tolist()]])

    table = common.stored(rows.repartitionByRange(*by, "key", "j").sortWithinPartitions(*by).mapInArrow(run, "key bigint, j int, name bigint, edge array<bigint>"), "names")
    same: dict[int, int] = {}
    for (name, *v), (after, *w) in meetings(edges_of(table)):
        if v == w:
            same[after] = same.get(name, name)
    out = table.where("key is not null").select("key", "j", "name")
    if same:  # as many as there are partitions at most
        other = table.sparkSession.createDataFrame(list(same.items()), "name bigint, whole bigint")
        out = out.join(F.broadcast(other), "name", "left").select("key", "j", F.coalesce("whole", "name").alias("name"))
    return out, table


def by_text(rows: DataFrame, column: str, alias: str) -> DataFrame:
    return rows.groupBy("key").agg(F.collect_list(F.struct("j", column)).alias(alias))


def sample_names(own: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``own`` with t, the sample's names of triples of phrases, as a stored table; and x by key, the names of longer
    prefixes of phrases that need them (none: None)."""
    names, table = named(triples(own, 0), 0)
    out = common.stored(own.join(by_text(names, "name", "t"), "key", "left"), "sample")
    common.release(table)
    deep, level, found, spent = out, 1, None, []
    while level < LEVELS:
        rows = common.stored(triples(deep, level), "triples")
        spent.append(rows)
        if rows.isEmpty():
            break
        names, table = named(rows, level)
        names = common.stored(names, "level")
        deep = common.stored(deep.drop("t").join(by_text(names, "name", "t"), "key"), "deep")
        spent += [table, names, deep]
        found = names if found is None else found.unionByName(names)
        level += 1
    x = common.stored(by_text(found, "name", "x"), "longer") if found is not None else None
    common.release(*spent)
    return out, x


def orders(own: DataFrame) -> DataFrame:
    """Two rows for each suffix: o, the phrases before the sample's names, and its key in that sort: c0 to c5."""
    width = KEYS + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            r = runs_of(b)
            found, text = flat(b, "t")
            t = r.spread(found.field("name").to_numpy(), found.field("j").to_numpy(), text)
            need, x = levels(r)[0], np.zeros(len(r.names) + 1, np.int64)
            if b.schema.field("x").type != pa.null() and len(flat(b, "x")[0]):
                longer, text = flat(b, "x")
                names, j = longer.field("name").to_numpy(), longer.field("j").to_numpy()
                wanted = np.zeros(len(r.names) + 1, np.int64)
                wanted[r.at] = need
                at = r.first[text] + j
                right = (names >> LEVEL_AT) - 1 == wanted[at]
                x[at[right]] = names[right]
            out = []
            for o in range(3):
                pick = r.own & (r.j % 3 != (0, 2, 1)[o])
                at, end = r.at[pick], r.end[pick]
                cols = [ahead(t, at, end, o + 3 * k) for k in range(KEYS)] + [ahead(x, at, end, o)]
                if o:
                    before = ahead(r.names, at, end, 0)
                    if o == 2:
                        before = common.mix(before.view(U64) * U64(31) + ahead(r.names, at, end, 1).view(U64)).view(np.int64)
                    cols.insert(0, before)
                else:
                    cols.append(np.zeros(len(at), np.int64))
                out.append((np.full(len(at), o, np.int8), r.text[pick], r.j[pick].astype(np.int32), *cols))
            o, text, j, *cols = (np.concatenate(c) for c in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(o), b.column("key").take(pa.array(text)), pa.array(j), *map(pa.array, cols)], names=["o", "key", "j", *(f"c{k}" for k in range(width))])

    return own.mapInArrow(run, "o tinyint, key bigint, j int, " + ", ".join(f"c{k} bigint" for k in range(width)))


def shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Phrases that rows [o, c0 ..] are sure to have in common with others: those of the leading columns that are equal."""
    same = np.logical_and.accumulate(a == b, axis=0)
    o = a[0].astype(np.int64)
    equal = same[1:].sum(0)
    names = np.minimum(np.where(o > 0, equal - 1, equal), KEYS)
    out = np.where(equal > 0, o + 3 * np.maximum(names, 0), 0)
    longer = a[1 + KEYS + (o > 0), np.arange(len(o))]
    whole = (equal >= KEYS + 1 + (o > 0)) & (longer > 0)
    return np.where(same[0], np.where(whole, o + 3 ** np.minimum(np.where(whole, longer >> LEVEL_AT, 0), LEVELS), out), 0)


def adjacent(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """key, j and most: phrases that a suffix shares with one next to it in a sort, for each sort; and the stored table."""
    by = ["o", *(c for c in rows.columns if c.startswith("c"))]
    columns = ["key", "j", "most", "edge"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for b in (x for x in batches if x.num_rows):
            v = np.stack([b.column(c).to_numpy().astype(np.int64) for c in by])
            key, j = b.column("key").to_numpy(), b.column("j").to_numpy()
            if last is None:
                yield batch(columns, edge=[[part, 0, int(key[0]), int(j[0]), *v[:, 0].tolist()]])
            else:
                v, key, j = np.concatenate([last[2], v], 1), np.append(last[0], key), np.append(last[1], j)
            both = shared(v[:, 1:], v[:, :-1])
            most = np.maximum(np.append(both, 0), np.append(0, both))
            some = most > 0
            yield batch(columns, key=key[some], j=j[some], most=most[some])
            last = key[-1:], j[-1:], v[:, -1:]
        if last is not None:
            yield batch(columns, edge=[[part, 1, int(last[0][0]), int(last[1][0]), *last[2][:, 0].tolist()]])

    table = common.stored(rows.repartitionByRange(*by, "key", "j").sortWithinPartitions(*by).mapInArrow(run, "key bigint, j int, most bigint, edge array<bigint>"), "adjacent")
    across = []
    for a, b in meetings(edges_of(table)):
        most = int(shared(np.array([a[2:]], np.int64).T, np.array([b[2:]], np.int64).T)[0])
        across += [(*x[:2], most) for x in (a, b) if most]
    out = table.where("key is not null").select("key", "j", "most")
    if across:  # twice as many as there are partitions at most
        out = out.unionByName(table.sparkSession.createDataFrame(across, "key bigint, j int, most bigint"))
    return out, table


def settled(own: DataFrame, most: DataFrame) -> DataFrame:
    """key, settled (start, end: bytes that repeat) and open (row, lo, hi: windows that begin lo to hi bytes before that row
    of phrases may repeat, and have bytes that are not settled).

    Two equal windows have the same anchors but for some before the first that SPREAD grams inside the window decide,
    and some after the last; that first one lies under SPREAD bytes from the start, and phrases match from it on to
    SPREAD grams before the end.
    """
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    opens = pa.list_(pa.struct([("row", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())]))

    def grouped(text: np.ndarray, n: int, kind: pa.DataType, *columns: np.ndarray) -> pa.Array:
        off = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))]).astype(np.int32)
        fields = [kind.value_type.field(i) for i in range(kind.value_type.num_fields)]
        return pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(columns, fields, strict=True)], fields=fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = np.int64(1) << 40
        for b in parts(batches):
            r = runs_of(b)
            found, text = flat(b, "most")
            shares = np.zeros(len(r.names) + 1, np.int64)
            if len(found):
                np.maximum.at(shares, r.first[text] + found.field("j").to_numpy(), found.field("most").to_numpy())
            pick = r.own
            text, at, end, rows = r.text[pick], r.at[pick], r.end[pick], r.rows[pick]
            n, start = shares[at], r.place(at, text)
            reach = r.place(np.minimum(at + n, end), text) + GRAM - start
            # two phrases more may be shared than the leading columns tell; if all are alike, any number
            far = r.place(np.minimum(np.where(n >= 3 * KEYS, end, at + n + 2), end), text) + GRAM - start
            sure = (n > 0) & (reach >= LENGTH)
            s, e = start[sure] + text[sure] * wide, (start + reach)[sure] + text[sure] * wide
            top = np.maximum.accumulate(e) if len(e) else e
            fresh = np.concatenate([[True], s[1:] > top[:-1]]) if len(s) else np.zeros(0, bool)
            s, e = s[fresh], top[np.append(np.flatnonzero(fresh)[1:] - 1, len(top) - 1)] if len(top) else top
            base = text * wide
            low = np.maximum(start - SPREAD + 1, 0) + base
            high = np.minimum(start, start + far - (LENGTH + 1 - SPREAD)) + base
            if len(s):  # windows inside a settled span need no look
                k = np.maximum(np.searchsorted(s, high, "right") - 1, 0)
                high = np.where((s[k] <= high) & (high + LENGTH <= e[k]), s[k] - 1, high)
                k = np.maximum(np.searchsorted(s, low, "right") - 1, 0)
                low = np.where((s[k] <= low) & (low + LENGTH <= e[k]), e[k] - LENGTH + 1, low)
            some = low <= high
            yield pa.RecordBatch.from_arrays(
                [b.column("key"), grouped(s // wide, b.num_rows, spans, s % wide, e % wide), grouped(text[some], b.num_rows, opens, rows[some], (start + base - high)[some], (start + base - low)[some])],
                names=["key", "settled", "open"],
            )

    found = own.join(most.groupBy("key").agg(F.collect_list(F.struct("j", "most")).alias("most")), "key", "left")
    return common.stored(found.select("key", "at", "names", "own", "most").mapInArrow(run, "key bigint, settled array<struct<start:int,end:int>>, open array<struct<row:bigint,lo:int,hi:int>>"), "settled")


def opened(own: DataFrame, spans: DataFrame) -> DataFrame:
    """key, at, lo, hi: the windows before rows of phrases of which any is open somewhere."""
    ranges = common.stored(spans.select(F.explode("open").alias("w")).groupBy("w.row").agg(F.min("w.lo").alias("lo"), F.max("w.hi").alias("hi")), "ranges")
    among = common.Among(ranges.select("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(among.mask(b)).select(["key", "row", "at"])

    each = own.select("key", "at", F.explode("own").alias("w")).select("key", F.col("w.row").alias("row"), F.get("at", "w.j").alias("at"), among.places("w.row").alias("places"))
    return each.mapInArrow(run, "key bigint, row bigint, at int").join(ranges, "row").select("key", "at", "lo", "hi")


def deduplicate(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and spans (start, end of each removed run).

    Null texts are empty. Texts of under LENGTH bytes keep all. Equal texts, rows that are the same row again among them,
    are looked at once; all their bytes go if they have LENGTH or more. A null doc_id is an id like others; other columns
    are not read.
    """
    rows = keyed(docs)
    long = rows.where(F.octet_length("text") >= LENGTH)
    twice = common.stored(long.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "twice")
    found = common.stored(phrases(rows).dropDuplicates(["key"]), "phrases", HANDED)
    own = repeated(found)
    common.release(found)
    sample, x = sample_names(own)
    most, table = adjacent(orders(sample.join(x, "key", "left") if x is not None else sample.withColumn("x", F.lit(None).cast("array<struct<j:int,name:bigint>>"))))
    spans = settled(own, most)
    common.release(sample, table, *([x] if x is not None else []))
    whole = long.join(twice, "key", "left_semi").select("key", F.lit(0).alias("start"), F.octet_length("text").alias("end")).distinct()
    sure = spans.select("key", F.explode("settled").alias("s")).select("key", "s.*").unionByName(whole)
    both = sure.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("settled")).join(opened(own, spans).groupBy("key").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("open")), "key", "full")
    both = common.stored(both, "parts")
    common.release(own, spans)
    among = common.Among(both.select("key"))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(among.mask(b)).select(["key", "text"])

    few = long.select("key", "text", among.places("key").alias("places")).mapInArrow(likely, "key bigint, text string")
    # copies of a text meet once in each partition before they are dealt out
    texts = common.stored(few.dropDuplicates(["key"]).join(both, "key").select("key", "text", "settled", "open"), "texts", HANDED)
    common.release(both)

    def clipped(b: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        """Bytes, where rows start, and of each open anchor: row, position, and lo and hi of the windows inside the text."""
        data, off = common.buffers(b.column("text"))
        open_ = b.column("open")
        at, lo, hi = (open_.flatten().field(i).to_numpy().astype(np.int64) for i in range(3))
        row = np.repeat(np.arange(b.num_rows), [len(x) for x in open_])
        lo, hi = np.maximum(lo, at + LENGTH - np.diff(off)[row]), np.minimum(hi, at)
        ok = lo <= hi
        return data, off, row[ok], at[ok], lo[ok], hi[ok]

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for y in batches for x in common.slices(y, "text", BYTES)):
            data, off, row, at, lo, hi = clipped(b)
            where = at + off[row]
            form = common.ByteHash(data).of(where - hi, where - lo + LENGTH) + common.mix((lo * SPREAD + hi).astype(U64))
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(row)), *(pa.array(x.astype(np.int32)) for x in (at, lo, hi)), pa.array(form.view(np.int64))], names=["key", "at", "lo", "hi", "form"])

    # anchors with all their windows' bytes alike: if there are two, all of these repeat; one of them stands for the rest
    around = common.stored(texts.where("open is not null").mapInArrow(contexts, "key bigint, at int, lo int, hi int, form bigint"), "contexts", HANDED)
    forms = common.stored(around.groupBy("form").agg(F.count("*").alias("n"), F.min(F.struct("key", "at", "lo", "hi")).alias("first")), "forms")
    alike = around.join(forms.where("n > 1").select("form"), "form").groupBy("key").agg(F.collect_list(F.struct((F.col("at") - F.col("hi")).alias("start"), (F.col("at") - F.col("lo") + LENGTH).alias("end"))).alias("alike"))
    chosen = forms.select("first.*").groupBy("key").agg(F.collect_list(F.struct("at", "lo", "hi")).alias("open"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for y in batches for x in common.slices(y, "text", BYTES)):
            data, off, row, at, lo, hi = clipped(b)
            lens, width = hi - lo + 1, np.int64(len(data) + 1)
            start = np.repeat(at - lo, lens) - (np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens))
            row, start = np.divmod(np.unique(np.repeat(row, lens) * width + start), width)  # anchors' ranges overlap
            where = start + off[row]
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(row)), pa.array(start.astype(np.int32)), pa.array(common.ByteHash(data).of(where, where + LENGTH).view(np.int64))], names=["key", "start", "hash"])

    seen = common.stored(texts.select("key", "text").join(chosen, "key").mapInArrow(hashed, "key bigint, start int, hash bigint"), "windows", HANDED)
    again = common.stored(seen.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "again")
    more = seen.join(again, "hash", "left_semi").groupBy("key").agg(F.collect_list("start").alias("starts"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for x in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                raw = x["text"].encode()
                flags = np.zeros(len(raw) + 1, np.int32)
                for s in (x["settled"] or []) + (x["alike"] or []):
                    flags[s["start"]] += 1
                    flags[s["end"]] -= 1
                starts = np.array(x["starts"] or [], np.int64)
                np.add.at(flags, starts, 1)
                np.add.at(flags, starts + LENGTH, -1)
                gone = np.concatenate([[False], np.cumsum(flags)[:-1] > 0, [False]])
                turns = np.flatnonzero(gone[1:] != gone[:-1])
                kept = np.frombuffer(raw, np.uint8)[~gone[1:-1]].tobytes()
                out.append((x["key"], int(gone.sum()), len(turns) // 2, hashlib.sha256(kept).hexdigest(), [{"start": int(s), "end": int(e)} for s, e in turns.reshape(-1, 2)]))
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["key", "n_removed", "n_spans", "kept", "spans"])

    done = common.stored(texts.join(more, "key", "left").join(alike, "key", "left").select("key", "text", "settled", "alike", "starts").mapInArrow(cut, "key bigint, n_removed bigint, n_spans bigint, kept string, spans array<struct<start:bigint,end:bigint>>"), "done", HANDED)
    common.release(texts, around, forms, seen, again)
    whole = rows.select("doc_id", "key", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    out = whole.join(done, "key", "left")
    return out.select("doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("kept", "sha").alias("kept_sha256"), "spans")

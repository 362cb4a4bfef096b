"""Operator 8: near-duplicates by an LSH forest of MinHash signatures.

Texts with equal shingle sets are one class. The signature of a class gives each tree of the forest a row or a column
of least hashes; the trees are the classes sorted by those. Classes next to each other that share a prefix of ``SHALLOW``
values or more are candidates: where few classes share a prefix the search is that shallow, where many do a class's
neighbours share longer ones, so the depth follows the density of the region. Where many similar classes crowd, those
with the most links are hubs, and every class of the region that is not yet connected to the hub is held against it.
Candidates are confirmed on full sets, the likeliest first; later rounds take those that still join two components.
Last, in each region that still has several components, all classes of different components are held against each
other in bounded blocks: no link between classes that share a region is left out for how crowded it is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm import common

WORDS, SHARE = 5, 75
#: Least hashes of a signature, sorted orders, values in each, and those that neighbours must share.
HASHES, TREES, DEPTH, SHALLOW = 96, 24, 6, 3
#: Where in the signature a tree's values are: the first trees take it in rows of ``DEPTH``, the others in columns of it.
ROWS = HASHES // DEPTH
PLACES = np.array([[t * DEPTH + d if t < ROWS else t - ROWS + d * ROWS for d in range(DEPTH)] for t in range(TREES)])
#: Neighbours before a class that are its candidates, and those confirmed in the first round.
NEAR, FIRST = 3, 3
#: Share of equal least hashes under which a candidate isn't confirmed: at similarity 0.75 it lies over 5.5 standard
#: deviations below the mean.
LEAST = 0.5
#: Classes and shingles in a side of a block, on average at most, and pairs whose signatures are compared at once.
BLOCK, MASS, ONCE = 2048, 1 << 21, 1 << 13
#: Rows with a text or with sets that Python gets at once at most, and bytes of text that are shingled at once.
WIDE, TEXT = 500, 1 << 19
U64 = np.uint64


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct word shingles of all rows, sorted within each, and how many each row has. A text of fewer than
    five words has its whole sequence as one; without words it has none."""
    words, counts = common.word_hashes(column, common.SOLID)
    ends = np.cumsum(counts)
    have = np.maximum(counts - WORDS + 1, 0)
    rolled = common.shingles(words, WORDS)
    at = np.repeat(ends - counts - (np.cumsum(have) - have), have) + np.arange(have.sum())
    row = np.repeat(np.arange(len(counts)), have)
    few = np.flatnonzero((counts > 0) & (counts < WORDS))
    whole = np.array([common.shingles(words[e - n : e], int(n))[0] for e, n in zip(ends[few], counts[few], strict=True)], U64)
    whole = common.mix(whole + counts[few].astype(U64))
    values, row = np.concatenate([rolled[at], whole]), np.concatenate([row, few])
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[fresh], np.bincount(row[fresh], minlength=len(counts))


def signatures(values: np.ndarray, counts: np.ndarray, n: int = HASHES) -> np.ndarray:
    """[row, n] least hashes, 32 bits of each; rows must not be empty."""
    starts = np.cumsum(counts) - counts
    mult = common.mix(np.arange(1, n + 1, dtype=U64)) | U64(1)
    out = np.empty((len(counts), n), np.int32)
    for k in range(n):
        h = values * mult[k]
        h ^= h >> U64(29)
        h *= U64(0xBF58476D1CE4E5B9)
        out[:, k] = (np.minimum.reduceat(h, starts) >> U64(32)).astype(np.uint32).view(np.int32)
    return out


def shingled(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, the set's 128-bit hash (h1, h2), and the signature (null for empty sets)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for y in batches for x in common.slices(y, "text", TEXT)):
            values, counts = shingle_sets(b.column("text"))
            full = np.flatnonzero(counts)
            starts = (np.cumsum(counts) - counts)[full]
            sums = np.zeros((2, len(counts)), U64)
            sig = np.zeros((len(counts), HASHES), np.int32)
            if len(full):
                for i, salt in enumerate((0x5851F42D4C957F2D, 0x14057B7EF767814F)):
                    sums[i, full] = np.add.reduceat(common.mix(values ^ U64(salt)), starts)
                sig[full] = signatures(values, counts[full])
            sig = pa.ListArray.from_arrays(pa.array(np.arange(len(counts) + 1, dtype=np.int32) * sig.shape[1]), pa.array(sig.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(counts, pa.int64()), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), sig], names=["doc_id", "n_shingles", "h1", "h2", "sig"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, h1 bigint, h2 bigint, sig array<int>")


def forest(classes: DataFrame) -> DataFrame:
    """A row per class and tree in which it shares ``SHALLOW`` leading values with another class: id, tree, region,
    key (the tree's values)."""
    keys = F.array(*(F.array(*(F.get("sig", int(p)) for p in places)) for places in PLACES))
    trees = classes.select("id", F.posexplode(keys).alias("tree", "key"))
    trees = trees.withColumn("region", F.xxhash64("tree", F.slice("key", 1, SHALLOW)))
    # stored, so that both sides of the join are plain shuffles and a hot region can be split
    crowded = common.stored(trees.groupBy("region").agg(F.count("*").alias("n")).where("n > 1").select("region"), "crowded")
    return trees.join(crowded, "region", "left_semi")


def neighbours(placed: DataFrame, classes: DataFrame) -> DataFrame:
    """Candidate pairs a < b of the sorted orders with est, the share of equal least hashes."""
    rows = placed.join(classes.select("id", "n", "sig"), "id").select("tree", "region", "key", "id", "n", "sig")
    schema = "a bigint, b bigint, est double, part int, tree int, region bigint, id bigint, n bigint, sig array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, kept, head = TaskContext.get().partitionId(), None, True
        names = ["a", "b", "est", "part", "tree", "region", "id", "n", "sig"]
        for b in batches:
            now = pa.Table.from_batches([b])
            both = now if kept is None else pa.concat_tables([kept, now])
            both = both.combine_chunks()
            yield from pairs_of(both, 0 if kept is None else kept.num_rows, names)
            if head:
                yield edge(now.slice(0, NEAR), 2 * part, names)
                head = False
            kept = both.slice(max(0, both.num_rows - NEAR))
        if kept is not None:
            yield edge(kept, 2 * part + 1, names)

    found = common.stored(rows.repartitionByRange("tree", "key", "id").sortWithinPartitions("tree", "key", "id").mapInArrow(run, schema), "neighbours")
    # the last rows of a partition next to the first of the one after it; as many rows as there are partitions
    edges = found.where("part is not null").select("part", F.struct("tree", "region", "id", "n", "sig").alias("row")).groupBy("part").agg(F.collect_list("row").alias("rows"))
    order = Window.orderBy("part")
    met = edges.withColumn("next", F.lead("rows").over(order)).where((F.col("part") % 2 == 1) & F.col("next").isNotNull())
    met = met.select(F.explode("rows").alias("x"), "next").select("x", F.explode("next").alias("y")).where("x.region = y.region")
    same = F.aggregate(F.zip_with("x.sig", "y.sig", lambda p, q: (p == q).cast("int")), F.lit(0), lambda s, e: s + e) / HASHES
    across = met.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"), same.alias("est"), F.col("x.n").alias("na"), F.col("y.n").alias("nb"))
    across = across.where((F.col("est") >= LEAST) & sized("na", "nb")).select("a", "b", "est")
    return found.where("part is null").select("a", "b", "est").unionByName(across).groupBy("a", "b").agg(F.max("est").alias("est"))


def sized(a: str, b: str) -> Column:
    """Whether sets of these sizes can reach the threshold at all."""
    return 100 * F.least(F.col(a), F.col(b)) >= SHARE * F.greatest(F.col(a), F.col(b))


def pairs_of(rows: pa.Table, fresh: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    n = rows.num_rows
    region, ids, size = (rows.column(c).to_numpy() for c in ("region", "id", "n"))
    sig = rows.column("sig").combine_chunks().flatten().to_numpy().reshape(n, -1) if n else None
    for step in range(1, min(NEAR, n - 1) + 1):
        i = np.arange(max(step, fresh), n)
        i = i[region[i] == region[i - step]]
        i = i[100 * np.minimum(size[i], size[i - step]) >= SHARE * np.maximum(size[i], size[i - step])]
        est = (sig[i] == sig[i - step]).mean(1)
        i, est = i[est >= LEAST], est[est >= LEAST]
        m = len(i)
        cols = [np.minimum(ids[i], ids[i - step]), np.maximum(ids[i], ids[i - step]), est]
        yield pa.RecordBatch.from_arrays([*map(pa.array, cols), *(pa.nulls(m, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())))], names=names)


def edge(rows: pa.Table, part: int, names: list[str]) -> pa.RecordBatch:
    m = rows.num_rows
    own = [rows.column(c).combine_chunks() for c in ("tree", "region", "id", "n", "sig")]
    return pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.float64()), pa.array([part] * m, pa.int32()), *own], names=names)


def sets_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """id and set of at least these distinct ids. ``texts`` has id and text of each class."""
    among = common.Among(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for y in batches for x in common.slices(y.filter(among.mask(y)), "text", TEXT)):
            values, counts = shingle_sets(b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("id"), common.lists(values.view(np.int64), counts, pa.int64())], names=["id", "set"])

    rows = texts.select("id", "text", among.places("id").alias("places"))
    return common.stored(rows.mapInArrow(run, "id bigint, set array<bigint>"), "sets", WIDE)


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs a, b whose full shingle sets reach the threshold."""
    sets = sets_of(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), texts)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            one, two = b.column("sa"), b.column("sb")
            for i in range(b.num_rows):
                p, q = one[i].values.to_numpy(), two[i].values.to_numpy()
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok[i] = 100 * both >= SHARE * (len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(ok))

    met = pairs.join(sets.withColumnsRenamed({"id": "a", "set": "sa"}), "a").join(sets.withColumnsRenamed({"id": "b", "set": "sb"}), "b")
    return common.stored(met.select("a", "b", "sa", "sb").mapInArrow(check, "a bigint, b bigint"), "links", WIDE)


def components(links: DataFrame) -> DataFrame:
    """id, component (the least id reachable) of every id in links a, b: each takes the least label of its neighbours,
    then the label of its label, until none changes."""
    both = common.stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = common.stored(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("b")).select("id", F.least("id", "b").alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        low = labels.join(near, "id").select("id", F.least("component", "near").alias("component"), F.col("component").alias("old"))
        of = labels.select(F.col("id").alias("component"), F.col("component").alias("up"))
        new = common.stored(low.join(of, "component").select("id", F.least("component", "up").alias("component"), "old"), "labels")
        done = new.where("component <> old").isEmpty()
        labels = new.select("id", "component")
        if done:
            return labels


def crossing(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs that the components do not connect."""
    out = pairs
    for side in ("a", "b"):
        out = out.join(labels.select(F.col("id").alias(side), F.col("component").alias(f"c{side}")), side, "left")
    return out.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).drop("ca", "cb")


def hub_pairs(placed: DataFrame, links: DataFrame, classes: DataFrame) -> DataFrame:
    """Each class of a crowded region with the class of that region that has the most links."""
    degree = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id"))).groupBy("id").agg(F.count("*").alias("degree"))
    hubs = placed.join(degree, "id").groupBy("region").agg(F.max(F.struct("degree", F.negative("id").alias("id"))).alias("top")).where("top.degree > 2").select("region", F.negative("top.id").alias("hub"))
    met = placed.join(common.stored(hubs, "hubs"), "region").where("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    sizes = classes.select("id", "n")
    met = met.join(sizes.withColumnsRenamed({"id": "a", "n": "na"}), "a").join(sizes.withColumnsRenamed({"id": "b", "n": "nb"}), "b")
    return met.where(sized("na", "nb")).select("a", "b")


def blocks(placed: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """The classes of regions that have several components, in blocks in which each class outside of its region's
    largest component meets all others of the region: block, tree, left, id, component, n. Left are those outside; their
    number times that of the region's classes, over ``BLOCK``, bounds the rows."""
    rows = placed.select("tree", "region", "id").join(classes.select("id", "n"), "id").join(labels, "id", "left")
    rows = common.stored(rows.select("tree", "region", "id", F.coalesce("component", "id").alias("component"), "n").distinct(), "members")
    parts = rows.groupBy("region", "component").agg(F.count("*").alias("m"), F.sum("n").alias("mass"))
    whole = parts.groupBy("region").agg(F.count("*").alias("parts"), F.sum("m").alias("m"), F.sum("mass").alias("mass"), F.max(F.struct("m", "mass", "component")).alias("top"))
    # two classes of a region are neighbours, and so settled
    whole = whole.where("parts > 1 and m > 2")

    def sides(m: Column, mass: Column) -> Column:
        return F.ceil(F.greatest(m / BLOCK, mass / MASS)).cast("bigint")

    lefts, rights = sides(F.col("m") - F.col("top.m"), F.col("mass") - F.col("top.mass")), sides(F.col("m"), F.col("mass"))
    met = rows.join(common.stored(whole.select("region", F.col("top.component").alias("top"), lefts.alias("lefts"), rights.alias("rights")), "unsettled"), "region")
    place = F.xxhash64("id")
    left = met.where("component <> top").withColumns({"left": F.lit(True), "i": F.pmod(place, "lefts"), "j": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rights") - 1))})
    right = met.withColumns({"left": F.lit(False), "i": F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("lefts") - 1)), "j": F.pmod(place, "rights")})
    return left.unionByName(right).select(F.xxhash64("region", "i", "j").alias("block"), "tree", "left", "id", "component", "n")


def each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block; batches are sorted by block."""
    kept = None
    for b in batches:
        now = pa.Table.from_batches([b])
        both = now if kept is None else pa.concat_tables([kept, now])
        block = both.column("block").to_numpy()
        starts = np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1]) if len(block) else np.zeros(1, np.int64)
        for at, end in zip(starts[:-1], starts[1:], strict=True):
            yield both.slice(at, end - at)
        kept = both.slice(starts[-1])
    if kept is not None and kept.num_rows:
        yield kept


def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of blocks that are in a pair of two components whose signatures and sizes don't rule it out, in the first
    tree in which the two meet."""
    for t in each_block(batches):
        t = t.combine_chunks()
        left, component, size = (t.column(c).to_numpy() for c in ("left", "component", "n"))
        tree, sig = t.column("tree")[0].as_py(), t.column("sig").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        one, two = np.flatnonzero(left), np.flatnonzero(~left)
        able = (component[one][:, None] != component[two]) & (100 * np.minimum(size[one][:, None], size[two]) >= SHARE * np.maximum(size[one][:, None], size[two]))
        p, q = np.nonzero(able)
        p, q, found = one[p], two[q], np.zeros(t.num_rows, bool)
        for at in range(0, len(p), ONCE):
            i, j = p[at : at + ONCE], q[at : at + ONCE]
            same = sig[i] == sig[j]
            ok = same.mean(1) >= LEAST
            i, j, same = i[ok], j[ok], same[ok][:, PLACES[:tree, :SHALLOW]]
            new = ~same.all(2).any(1)
            found[i[new]] = found[j[new]] = True
        if found.any():
            yield from t.drop_columns(["sig", "tree", "n"]).filter(pa.array(found)).to_batches()


def joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block, links that join all components of it that any link joins; rows that aren't left come first."""
    for t in each_block(batches):
        t = t.combine_chunks()
        sets = t.column("set").combine_chunks()
        ids, size = t.column("id").to_numpy(), sets.value_lengths().to_numpy().astype(np.int64)
        values = np.unique(sets.flatten().to_numpy(), return_inverse=True)[1]
        component = np.unique(t.column("component").to_numpy(), return_inverse=True)[1]
        ends, n = np.cumsum(size), int((~t.column("left").to_numpy()).sum())
        if not n:
            continue
        held, starts, has, out = values[: ends[n - 1]], (ends - size)[:n], np.zeros(values.max() + 1, np.int32), []
        for x in range(n, len(ids)):
            able = (component[:n] != component[x]) & (100 * np.minimum(size[:n], size[x]) >= SHARE * np.maximum(size[:n], size[x]))
            if not able.any():
                continue
            own = values[ends[x] - size[x] : ends[x]]
            has[own] = 1
            both = np.add.reduceat(has[held], starts)
            has[own] = 0
            for y in np.flatnonzero(able & (100 * both >= SHARE * (size[:n] + size[x] - both))):
                if component[y] != component[x]:
                    out.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
                    component[component == component[y]] = component[x]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in zip(*out, strict=True)], names=["a", "b"])


def crossing_links(placed: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links that join all components which any link between classes of one region joins."""
    rows = blocks(placed, labels, classes).join(classes.select("id", "sig"), "id").select("block", "tree", "left", "id", "component", "n", "sig")
    schema = "block bigint, left boolean, id bigint, component bigint"
    rows = common.stored(rows.repartition("block").sortWithinPartitions("block").mapInArrow(likely, schema), "likely").distinct()
    met = rows.join(sets_of(rows.select("id").distinct(), texts).where(F.size("set") > 0), "id").select("block", "left", "id", "component", "set")
    return common.stored(met.repartition("block").sortWithinPartitions("block", "left").mapInArrow(joining, "a bigint, b bigint"), "links", WIDE)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_shingles, component_id, kept.

    Null, empty and wordless texts have no shingles and are linked with nothing. Rows that repeat a doc_id are one
    document, linked by any of their texts, kept or not together; rows with a null doc_id are linked with nothing and kept. Other columns are not
    read.
    """
    rows = common.stored(shingled(docs), "shingled", WIDE)
    able = rows.where("doc_id is not null and n_shingles > 0")
    classes = common.stored(able.groupBy("h1", "h2", F.col("n_shingles").alias("n")).agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig")), "classes")
    own = docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("id"), "text")
    if not able.groupBy("doc_id", "h1", "h2", "n_shingles").agg(F.count("*").alias("rows")).where("rows > 1").isEmpty():
        own = own.distinct()
    placed = common.stored(forest(classes), "forest")
    pairs = common.stored(neighbours(placed, classes), "pairs")
    ends = pairs.select("a", "b", "est", F.explode(F.array("a", "b")).alias("id"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("est"), "a", "b"))
    first = common.stored(ends.withColumn("rank", rank).where(F.col("rank") <= FIRST).select("a", "b").distinct(), "first")
    links = confirmed(first, own)
    labels = components(links)
    while True:  # until no pair joins two components
        rest = crossing(pairs.select("a", "b").unionByName(hub_pairs(placed, links, classes)).distinct(), labels).join(first, ["a", "b"], "left_anti")
        rest = common.stored(rest, "rest")
        more = confirmed(rest, own)
        if more.isEmpty():
            break
        first, links = first.unionByName(rest), links.unionByName(more)
        labels = components(links)
    more = crossing_links(placed, labels, classes, own)
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    ids = classes.join(labels, "id", "left").select("h1", "h2", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component"))
    out = rows.join(ids, ["h1", "h2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component"))
    return out.select("doc_id", "n_shingles", F.coalesce(component, "doc_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

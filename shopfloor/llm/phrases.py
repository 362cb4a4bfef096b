"""Operator 12: phrases whose words stand together more often than their parts' counts explain.

Counts of all frequent phrases of 1 to ``longest`` words are gathered length by length: a phrase is counted only where
its shorter parts are frequent. The counts are then laid out as two sorted streams. In prefix order every phrase comes
after all phrases it begins with, in suffix order after all it ends with, so one running pass over each stream gives the
counts of all left and right parts and tells which phrases a longer one covers; a merge join puts the two passes together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopfloor.llm import common

LONGEST, LEAST, COVER, TOP = 5, 100, 100, 2000
#: Lengths that one scan counts; the last scan's lengths are all sieved by the one before.
SCANS = ((1,), (2,), (3,), (4, 5))
#: Parts that the phrases of one first or last word are dealt to, by their next word.
SALTS = 16
#: Most bits of a sieve. It lets more through beyond some 5 million phrases, which costs time alone.
SIEVE = 1 << 26
SLICE = 1 << 20
BREAK = np.zeros(256, bool)
BREAK[[33, 44, 46, 58, 59, 63, 10, 11, 12, 13]] = True
INSIDE = ~BREAK
INSIDE[[9, 32]] = False
COUNTS = "lang string, phrase string, n bigint"


class Sieve:
    """A Bloom filter over phrases of a language, of bounded size: no phrase that it was made of is left out."""

    def __init__(self, phrases: DataFrame):
        """``phrases`` has lang and phrase."""
        self.bits = min(SIEVE, 1 << max(16, (12 * phrases.count()).bit_length()))
        bits = self.bits

        def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                data, off = common.buffers(batch.column("phrase"))
                at = Sieve.places(common.ByteHash(data).of(off[:-1], off[1:]), batch.column("lang"), bits).ravel()
                slot, bit = at >> 6, np.left_shift(np.int64(1), at & 63)
                order = np.argsort(slot, kind="stable")
                slot, start = np.unique(slot[order], return_index=True)
                if len(slot):
                    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.bitwise_or.reduceat(bit[order], start))], names=["slot", "bits"])

        found = phrases.select("lang", "phrase").mapInArrow(slots, "slot bigint, bits bigint").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow()
        self.set = np.zeros(self.bits // 64, np.int64)
        self.set[found.column("slot").to_numpy()] = found.column("bits").to_numpy()

    @staticmethod
    def places(hashes: np.ndarray, langs: pa.Array, bits: int) -> np.ndarray:
        """Three bits of each phrase."""
        data, off = common.buffers(langs)
        own = hashes ^ common.ByteHash(data).of(off[:-1], off[1:])
        return np.stack([(common.mix(own + common.U64(i)) % common.U64(bits)).astype(np.int64) for i in range(1, 4)])

    def holds(self, hashes: np.ndarray, langs: pa.Array) -> np.ndarray:
        at = self.places(hashes, langs, self.bits)
        return (((self.set[at >> 6] >> (at & 63)) & 1) == 1).all(0)


class Words:
    """The words of a slice of texts, lower-cased in A-Z, as one buffer with a space after each, and their numbers:
    equal words of one language have one number."""

    def __init__(self, batch: pa.RecordBatch):
        data, off = common.buffers(batch.column("text"))
        low = common.LOWER[data]
        start, end, self.row = common.runs(low, off, INSIDE)
        broken = np.concatenate([[0], np.cumsum(BREAK[low], dtype=np.int32)])
        #: Whether a word and the next are of one piece.
        self.joined = np.zeros(len(start), bool)
        self.joined[:-1] = (self.row[1:] == self.row[:-1]) & (broken[start[1:]] == broken[end[:-1]])
        size = end - start + 1
        self.at = np.concatenate([[0], np.cumsum(size)])
        self.text = np.append(low, np.uint8(32))[np.repeat(start - self.at[:-1], size) + np.arange(self.at[-1])]
        self.text[self.at[1:] - 1] = 32
        self.hash = common.ByteHash(self.text)
        self.langs, lang = batch.column("lang").dictionary_encode().dictionary, batch.column("lang").dictionary_encode().indices.to_numpy()
        self.lang = lang[self.row].astype(np.int64)
        own = common.mix(self.hash.of(self.at[:-1], self.at[1:] - 1) + (self.lang.astype(common.U64) + common.U64(1)) * common.U64(common.BASE))
        self.first, self.number, self.count = np.unique(own, return_index=True, return_inverse=True, return_counts=True)[1:]

    def phrases(self, first: np.ndarray, n: int) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """Language, text and hash of the phrases of n words that begin at some words."""
        start, end = self.at[first], self.at[first + n] - 1
        size = end - start
        off = np.concatenate([[0], np.cumsum(size)])
        data = self.text[np.repeat(start - off[:-1], size) + np.arange(off[-1])]
        text = pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(off.astype(np.int32)), pa.py_buffer(data)])
        return self.langs.take(pa.array(self.lang[first])), text, self.hash.of(start, end)


def counted(docs: DataFrame, lengths: tuple[int, ...], sieve: Sieve | None) -> DataFrame:
    """lang, phrase and n: occurrences, added up within slices. With the words come rows of no phrase, for all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for b in batches for part in common.slices(b, "text", SLICE)):
            words = Words(batch)
            if not len(words.row):
                continue
            if sieve is None:
                lang, text, _ = words.phrases(words.first, 1)
                yield pa.RecordBatch.from_arrays([lang, text, pa.array(words.count)], schema=OUT)
                each = np.bincount(words.lang, minlength=len(words.langs))
                yield pa.RecordBatch.from_arrays([words.langs, pa.nulls(len(each), pa.string()), pa.array(each)], schema=OUT)
                continue
            # numbers of ever longer phrases, from those of their first words and of their last words
            number, ok, first = words.number, np.ones(len(words.row), bool), words.first
            for n in range(1, max(lengths) + 1):
                if n > 1:
                    both = ok.copy()
                    both[:-1] &= ok[1:] & words.joined[:-1]
                    both[-1] = False
                    at = np.flatnonzero(both)
                    named = np.full(len(ok), -1)
                    _, k, named[at], counts = np.unique(number[at] * (len(ok) + 1) + number[at + 1], return_index=True, return_inverse=True, return_counts=True)
                    number, ok, first = named, both, at[k]
                    if n in lengths and len(first):
                        lang, text, _ = words.phrases(first, n)
                        yield pa.RecordBatch.from_arrays([lang, text, pa.array(counts)], schema=OUT)
                if n == min(lengths) - 1 and len(first):
                    lang, _, hashes = words.phrases(first, n)
                    ok = ok & np.append(sieve.holds(hashes, lang), False)[number]

    OUT = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(count, COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def frequent(docs: DataFrame, least: int) -> tuple[list[DataFrame], DataFrame]:
    """The phrases with ``least`` occurrences or more, a stored table for each scan, and n of each language."""
    sieve, tables = None, []
    for lengths in SCANS:
        found = counted(docs, lengths, sieve).where((F.col("n") >= least) | F.col("phrase").isNull())
        tables.append(common.stored(found, f"phrases{lengths[0]}"))
        if lengths != SCANS[-1]:
            sieve = Sieve(tables[-1].where("phrase is not null"))
    return tables, tables[0].where("phrase is null").select("lang", "n")


def parts(counts: DataFrame, words: Column, name: str) -> DataFrame:
    """lang, phrase, f and ``name``: the counts of the first 1, 2, ... of ``words``. Rows go in the order of ``words``, in
    which the last phrase of k words before a longer one is what that one begins with; single words are in every part of
    theirs."""
    own = counts.withColumn("w", words)
    salt = F.when(F.size("w") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.pmod(F.xxhash64(F.get("w", F.lit(1))), F.lit(SALTS)).cast("int")))
    own = own.withColumn("salt", F.explode(salt))
    w = Window.partitionBy("lang", F.get("w", F.lit(0)), "salt").orderBy("w").rowsBetween(Window.unboundedPreceding, 0)
    seen = [F.last(F.when(F.size("w") == k, F.col("f")), ignorenulls=True).over(w) for k in range(1, LONGEST)]
    return own.withColumn(name, F.array(*seen)).where(F.size("w") > 1).drop("salt")


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)), exact: products in decimals of 38 digits."""
    big = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", big(a * 1000) * big(n), big(left) * big(right))


def collocations(docs: DataFrame, least: int = LEAST, cover: int = COVER, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best ``top`` phrases of each language.

    A phrase covered by a longer one (with ``cover`` percent of its occurrences or more) is left out; it is enough to look
    at those of one word more, for what has the longer one has them too, at least as often. Memory is that of a slice of
    text; counts are Spark's, of all documents. Null texts are empty, a null lang is ``und``; repeated rows and ids count
    as often as they are there; an empty table gives no rows. Other columns are not read.
    """
    tables, words = frequent(docs, least)
    counts = tables[0]
    for t in tables[1:]:
        counts = counts.unionByName(t)
    counts = counts.where("phrase is not null").select("lang", "phrase", F.split("phrase", " ").alias("words"), F.col("n").alias("f"))
    ahead, behind = parts(counts, F.col("words"), "lefts"), parts(counts, F.reverse("words"), "rights")
    m = F.size("words")
    covering = lambda t, c, start: t.where((m > 2) & (F.col("f") * 100 >= F.get(c, m - 2) * cover)).select("lang", F.array_join(F.slice("words", F.lit(start), m - 1), " ").alias("phrase"))
    longer = covering(ahead, "lefts", 1).unionByName(covering(behind, "rights", 2))
    both = ahead.hint("merge").join(behind.select("lang", "phrase", "rights"), ["lang", "phrase"]).join(longer, ["lang", "phrase"], "left_anti").join(words, "lang")

    def cut(k: Column) -> Column:
        left, right = F.get("lefts", k - 1), F.get("rights", m - k - 1)
        return F.struct(score(F.col("f"), F.col("n"), left, right).alias("score"), k.alias("k"), left.alias("l"), right.alias("r"))

    out = both.withColumn("c", F.array_min(F.transform(F.sequence(F.lit(1), m - 1), cut))).select("lang", "phrase", F.col("f").alias("a"), "c.l", "c.r", "n", "c.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return out.withColumn("rank", F.row_number().over(best).cast("bigint")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = rf"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]')) as piece from documents
), listed as (
  select lang, row_number() over () as p, regexp_extract_all(piece, '[^ \t]+') as w from pieces
), spoken as (
  select lang, p, unnest(w) as w, generate_subscripts(w, 1) as i from listed
), ahead as (
  select lang, w as w1, w || ' ' || lead(w, 1) over o as w2, lead(w, 2) over o as n3, lead(w, 3) over o as n4, lead(w, 4) over o as n5 from spoken window o as (partition by p order by i)
), counts as (
  select lang, 1 as k, w1 as phrase, count(*) as f from ahead group by all
  union all select lang, 2, w2, count(*) from ahead where w2 is not null group by all
  union all select lang, 3, w2 || ' ' || n3 as phrase, count(*) from ahead where n3 is not null group by all having count(*) >= {LEAST}
  union all select lang, 4, w2 || ' ' || n3 || ' ' || n4 as phrase, count(*) from ahead where n4 is not null group by all having count(*) >= {LEAST}
  union all select lang, 5, w2 || ' ' || n3 || ' ' || n4 || ' ' || n5 as phrase, count(*) from ahead where n5 is not null group by all having count(*) >= {LEAST}
), words as (
  select lang, sum(f) as n from counts where k = 1 group by lang
), candidates as (
  select *, string_split(phrase, ' ') as w from counts where k > 1 and f >= {LEAST}
), covered as (
  select lang, array_to_string(w[1 : k - 1], ' ') as phrase, f from candidates where k > 2 union all select lang, array_to_string(w[2 : k], ' '), f from candidates where k > 2
), left_over as (
  select c.* from candidates c where not exists (select 1 from covered o where o.lang = c.lang and o.phrase = c.phrase and 100 * o.f >= {COVER} * c.f)
), cuts as (
  select c.lang, c.phrase, c.f as a, l.f as l, r.f as r, n, t.i, (1000 * c.f::hugeint * n::hugeint) // (l.f::hugeint * r.f::hugeint) as score
  from left_over c join range(1, {LONGEST}) t(i) on t.i < c.k join counts l on l.lang = c.lang and l.phrase = array_to_string(c.w[1 : t.i], ' ') join counts r on r.lang = c.lang and r.phrase = array_to_string(c.w[t.i + 1 : c.k], ' ') join words on words.lang = c.lang
), best as (
  select * from cuts qualify row_number() over (partition by lang, phrase order by score, i) = 1
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score from best
qualify rank <= {TOP}
"""

"""Operator 1: line dedup by a log-template tree, in DataFrame functions alone.

A line's words, with variable ones (those that hold a digit) masked, lead down a tree of fixed depth: their number,
then the first ``DEPTH`` words. In a leaf, a word stays in the template if enough documents, and a large enough share of
the leaf's, have it in its place; others become variable. The share makes a field's words variable however many lines
there are. A template that enough documents share and that keeps enough of its words is recurring; so is a masked line
that by itself is in enough documents. Recurring lines are dropped from every document but the first that has the
template. Copies of whole documents in fewer are left to near-dedup.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopfloor.llm import common

#: Levels of words below that of their number.
DEPTH = 3
#: Documents that must share a template, the share of them that must have a word for it to be fixed, and the share of a
#: template's words that must be fixed.
DOCUMENTS, SHARE, FIXED = 10, 0.05, 0.7
MASK = "<*>"


def spaced(line: Column) -> Column:
    """A line with its words single-spaced."""
    odd = line.contains("  ") | line.contains("\t") | line.contains("\r")
    return F.trim(F.when(odd, F.regexp_replace(line, r"[ \t\r]+", " ")).otherwise(line))


def masked(line: Column) -> Column:
    """A single-spaced line with the words that hold a digit masked."""
    return F.regexp_replace(line, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", MASK)


def lines_of(docs: DataFrame) -> DataFrame:
    """A row per line with words: doc_id, row_key, n (line number from 0), line (single-spaced), leaf."""
    each = docs.select("doc_id", common.text_key().alias("row_key"), F.posexplode(F.split("text", "\n")).alias("n", "line"))
    each = each.withColumn("line", spaced(F.col("line"))).where("line <> ''")
    size = F.length("line") - F.length(F.replace("line", F.lit(" "))) + 1
    return each.withColumn("size", size).withColumn("leaf", F.xxhash64("size", masked(F.substring_index("line", " ", DEPTH)))).drop("size")


def placed_lines(docs: DataFrame, documents: int) -> DataFrame:
    """The lines, masked, of leaves that enough lines reach for one of them to recur, as a stored table."""
    lines = lines_of(docs)
    # stored, so that both sides of the join are plain shuffles and a hot leaf can be split
    leaves = common.stored(lines.groupBy("leaf").agg(F.count("*").alias("lines")).where(F.col("lines") >= documents).select("leaf"), "leaves")
    kept = lines.join(leaves, "leaf", "left_semi").withColumn("line", masked(F.col("line")))
    out = common.stored(kept.withColumn("line_key", F.xxhash64("line")), "lines")
    common.release(leaves)
    return out


def templates(lines: DataFrame, documents: int = DOCUMENTS, fixed: float = FIXED, share: float = SHARE) -> DataFrame:
    """Of placed lines, those that recur: line_key (hash of the masked line), template, documents, and the place of the
    template's first line (doc_id, row_key, n), as a stored table."""
    # copies of a line inside one document count once
    once = (
        lines.groupBy("leaf", "line", "line_key", "doc_id", "row_key")
        .agg(F.min("n").alias("n"))
        .groupBy("leaf", "line", "line_key")
        .agg(F.count("*").alias("documents"), F.min(F.struct("doc_id", "row_key", "n")).alias("first"))
    )
    once = common.stored(once, "once")
    whole = common.stored(once.groupBy("leaf").agg(F.sum("documents").alias("all")).where(F.col("all") >= documents), "whole")
    words = once.join(whole, "leaf").select("leaf", "line_key", "documents", "all", F.posexplode(F.split("line", " ")).alias("at", "word"))
    enough = F.greatest(F.lit(documents), F.col("all") * share)
    kept = words.groupBy("leaf", "at", "word").agg(F.sum("documents").alias("d"), F.first("all").alias("all")).where((F.col("d") >= enough) & (F.col("word") != MASK))
    # stored for the same reason: in a hot leaf most lines have the same word in a place
    kept = common.stored(kept.select("leaf", "at", "word", F.lit(1).alias("fixed")), "kept")
    form = words.join(kept, ["leaf", "at", "word"], "left").groupBy("line_key").agg(
        F.sort_array(F.collect_list(F.struct("at", F.when(F.col("fixed") == 1, F.col("word")).otherwise(MASK).alias("word")))).alias("words"), F.avg(F.coalesce("fixed", F.lit(0))).alias("share")
    )
    form = form.where(F.col("share") >= fixed).select("line_key", F.array_join(F.col("words.word"), " ").alias("template"))
    form = common.stored(form.join(once.select("line_key", "documents", "first"), "line_key"), "forms")
    found = form.groupBy("template").agg(F.sum("documents").alias("documents"), F.min("first").alias("first")).where(F.col("documents") >= documents)
    general = common.stored(form.select("line_key", "template").join(found, "template"), "general")
    single = once.where(F.col("documents") >= documents).join(general.select("line_key"), "line_key", "left_anti")
    out = common.stored(general.unionByName(single.select("line_key", F.col("line").alias("template"), "documents", "first")), "templates")
    common.release(once, whole, kept, form, general)
    return out


def dropped_lines(docs: DataFrame, documents: int = DOCUMENTS, fixed: float = FIXED, share: float = SHARE) -> DataFrame:
    """doc_id, row_key and gone, the numbers of the lines that are dropped."""
    lines = placed_lines(docs, documents)
    found = templates(lines, documents, fixed, share).select("line_key", "first")
    lines = lines.join(found, "line_key")
    lines = lines.where(~F.col("first").eqNullSafe(F.struct("doc_id", "row_key", "n")))
    return lines.groupBy("doc_id", "row_key").agg(F.collect_set("n").alias("gone"))


def deduplicate(docs: DataFrame, documents: int = DOCUMENTS, fixed: float = FIXED, share: float = SHARE) -> DataFrame:
    """All rows and columns of docs with text less its dropped lines, and n_lines and n_dropped.

    A null text stays null and has no lines; an empty one has one. Rows that repeat doc_id and text are one document
    and lose the same lines; a null doc_id is an id like others. Lines without words stay. The first document of a
    template is that with the least doc_id. Columns named n_lines or n_dropped are replaced; any others stay.
    """
    rows = docs.drop("n_lines", "n_dropped")
    own, key, numbers = common.fresh(rows, 3)
    gone = dropped_lines(docs.select("doc_id", "text"), documents, fixed, share).select(F.col("doc_id").alias(own), F.col("row_key").alias(key), F.col("gone").alias(numbers))
    met = rows.join(gone, F.col("doc_id").eqNullSafe(F.col(own)) & (common.text_key() == F.col(key)), "left")
    lines, some = F.split("text", "\n"), F.col(numbers).isNotNull()
    left = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(numbers, i)), "\n")
    counted = {"n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("bigint"), "n_dropped": F.when(some, F.size(numbers)).otherwise(0).cast("bigint")}
    return met.withColumns({**counted, "text": F.when(some, left).otherwise(F.col("text"))}).drop(own, key, numbers)


ORACLE_SQL = f"""
with lines as (
  select doc_id, n - 1 as n, trim(regexp_replace(raw, '[ \\t\\r]+', ' ', 'g')) as line
  from (select doc_id, unnest(string_split(text, chr(10))) as raw, generate_subscripts(string_split(text, chr(10)), 1) as n from documents)
), mask as (
  select doc_id, n, regexp_replace(line, '[^ ]*[0-9][^ ]*', '{MASK}', 'g') as line from lines
), worded as (
  select doc_id, n, line, len(string_split(line, ' ')) as size, array_to_string(string_split(line, ' ')[1:{DEPTH}], ' ') as head from mask where line <> ''
), leaves as (
  select size, head from worded group by size, head having count(*) >= {DOCUMENTS}
), once as (
  select size, head, line, count(distinct doc_id) as documents, min({{'d': doc_id, 'n': n}}) as first
  from worded join leaves using (size, head) group by size, head, line
), whole as (
  select size, head, sum(documents) as everyone from once group by size, head having sum(documents) >= {DOCUMENTS}
), words as (
  select size, head, line, documents, everyone, unnest(string_split(line, ' ')) as word, generate_subscripts(string_split(line, ' '), 1) as pos from once join whole using (size, head)
), kept as (
  select size, head, pos, word from words where word <> '{MASK}' group by size, head, pos, word, everyone having sum(documents) >= greatest({DOCUMENTS}, everyone * {SHARE})
), form as (
  select w.line, string_agg(case when k.word is null then '{MASK}' else w.word end, ' ' order by w.pos) as template, avg(case when k.word is null then 0 else 1 end) as share
  from words w left join kept k on w.size = k.size and w.head = k.head and w.pos = k.pos and w.word = k.word group by w.line
), forms as (
  select template, line, documents, first from form join once using (line) where share >= {FIXED}
), general as (
  select line, min(first) over (partition by template) as first, sum(documents) over (partition by template) as documents from forms
), recurring as (
  select line, first from general where documents >= {DOCUMENTS}
  union all
  select line, first from once where documents >= {DOCUMENTS} and line not in (select line from general where documents >= {DOCUMENTS})
), gone as (
  select l.doc_id, l.n from worded l join recurring r on l.line = r.line where not (r.first.d = l.doc_id and r.first.n = l.n)
), raw as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) - 1 as n from documents
), left_over as (
  select r.doc_id, string_agg(case when g.n is null then r.line end, chr(10) order by r.n) as text, count(*) as n_lines, count(g.n) as n_dropped
  from raw r left join gone g on r.doc_id = g.doc_id and r.n = g.n group by r.doc_id
)
select d.doc_id, case when d.text is null then null else coalesce(l.text, '') end as text, coalesce(l.n_lines, 0) as n_lines, coalesce(l.n_dropped, 0) as n_dropped
from documents d left join left_over l on d.doc_id = l.doc_id
"""

"""Operator 13: conversations as training windows of a token budget.

Prefix sums of the turns' tokens cut a conversation into spans of whole turns. A window holds the conversation's system
turn, as many turns before its span as the history's budget takes, and the span itself; only the span's assistant texts
are under the loss mask, so each of them is a target once, however often it is repeated as history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUDGET, HISTORY = 1024, 256  # tokens of a window, and of its repeated turns
#: Turns of a section, by number, as a power of two, and those at a section's end that the next one sees as history.
SECTION, CONTEXT = 9, 64
#: What a turn costs beside its text, and the pieces that count as a text's tokens.
MARKS, PIECE = 4, "[A-Za-z]{1,5}|[0-9]{1,3}|[^A-Za-z0-9\\x09-\\x0D\\x20]"
OPEN, CLOSE, LOSS = "<|im_start|>", "<|im_end|>\n", "assistant"


def escaped(text: Column) -> Column:
    """No control string is left: each < before any backslashes and | has one backslash more after it."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def tokens(text: Column) -> Column:
    """About the tokens of a text, by functions of Spark alone."""
    return F.regexp_count(text, F.lit(PIECE)).cast("bigint") + MARKS


def sections(turns: DataFrame) -> DataFrame:
    """conv_id, section and its turns in order: its own, and before them the last ones of the section before and the
    conversation's system turn. No group holds more than a section, so a conversation of any length is many rows."""
    text = F.coalesce("text", F.lit(""))
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), text.alias("text"), tokens(text).alias("cost"))
    # a turn without a number is before all others
    rows = rows.withColumn("section", F.coalesce(F.shiftright("turn", SECTION), F.lit(-(1 << 62))))
    last = F.coalesce(F.col("turn").bitwiseAND((1 << SECTION) - 1) >= (1 << SECTION) - CONTEXT, F.lit(False))
    places = F.when(last, F.array("section", F.col("section") + 1)).otherwise(F.array("section"))
    both = rows.withColumn("_at", F.explode(places)).withColumns({"own": F.col("_at") == F.col("section"), "section": F.col("_at")}).drop("_at")
    system = rows.where("role = 'system'").groupBy("conv_id").agg(F.min(F.struct("turn", "role", "text", "cost", "section")).alias("s"))
    later = rows.where("section > 0 or section < -1").select(F.col("conv_id").alias("c"), F.col("section").alias("at")).distinct()
    near = F.coalesce(F.col("s.turn").bitwiseAND((1 << SECTION) - 1) >= (1 << SECTION) - CONTEXT, F.lit(False)) & (F.col("at") == F.col("s.section") + 1)
    seen = later.join(system, F.col("c").eqNullSafe(F.col("conv_id"))).where((F.col("at") > F.col("s.section")) & ~near)
    both = both.unionByName(seen.select("conv_id", "s.turn", "s.role", "s.text", "s.cost", F.col("at").alias("section"), F.lit(False).alias("own")))
    found = both.groupBy("conv_id", "section").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text", "cost", "own"))).alias("turns"))
    return found.where(F.exists("turns", lambda t: t.own))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, section, window, n_tokens, n_repeated (turns at the head that an earlier window had), text, and loss, the
    code points under the mask as (start, length). Section and window order a conversation's windows.

    A window is within ``budget`` unless its span is one turn, which is never cut, or the system turn takes over half of
    what history leaves. Null texts and roles are empty; rows are ordered by turn (without one first), role and text, and
    rows that repeat are turns each; a null conv_id is a conversation. Rows of one conv_id and one turn meet in a section,
    however many. An empty table gives none. Other columns are not read.
    """
    size, at = F.size("turns"), lambda c, k: F.get(c, k)
    first = sections(turns).withColumn("before", F.size(F.filter("turns", lambda t: ~t.own)))
    # where the first system turn is, and the tokens before each turn, places from 0
    first = first.withColumn("system", F.array_position(F.transform("turns", lambda t: t.role), "system").cast("int") - 1)
    first = first.withColumn("sums", F.aggregate("turns", F.array(F.lit(0).cast("bigint")), lambda acc, t: F.concat(acc, F.array(F.element_at(acc, -1) + t.cost))))
    room = F.greatest(F.lit((budget - history) // 2).cast("bigint"), F.lit(budget - history) - F.when(F.col("system") >= 0, at("turns", F.col("system")).cost).otherwise(0))
    first = first.withColumn("room", room)
    opens = lambda acc, k: F.size(acc).__eq__(0) | (at(F.col("sums"), k + 1) - at(F.col("sums"), F.element_at(acc, -1)) > F.col("room"))
    cut = F.aggregate(F.sequence("before", size - 1), F.array().cast("array<int>"), lambda acc, k: F.when(opens(acc, k), F.concat(acc, F.array(k))).otherwise(acc))
    # (outer, though none is empty: else a filter on the cuts would go below the sums and add them up again for each turn)
    cut = first.withColumn("cuts", cut).select("conv_id", "section", "turns", "system", "sums", "cuts", F.posexplode_outer("cuts").alias("window", "begin"))
    cut = cut.withColumn("end", F.coalesce(at(F.col("cuts"), F.col("window") + 1), size))
    past = F.filter("sums", lambda s, k: (k < F.col("begin")) & (at(F.col("sums"), F.col("begin")) - s <= history))
    cut = cut.withColumn("from", F.col("begin") - F.size(past))
    kept = F.slice("turns", F.col("from") + 1, F.col("end") - F.col("from"))
    apart = (F.col("system") >= 0) & (F.col("system") < F.col("from"))
    made = cut.select("conv_id", "section", "window", (F.col("begin") - F.col("from") + apart.cast("int")).alias("n_repeated"), F.concat(F.when(apart, F.slice("turns", F.col("system") + 1, 1)).otherwise(F.slice("turns", 1, 0)), kept).alias("turns"))
    piece = lambda t: F.struct((t.role == LOSS).alias("target"), t.cost.alias("cost"), F.concat(F.lit(OPEN), F.url_encode(t.role), F.lit("\n")).alias("head"), escaped(t.text).alias("text"))
    made = made.withColumn("pieces", F.transform("turns", piece)).drop("turns")
    spans = lambda acc, p: F.struct((acc.at + F.length(p.head) + F.length(p.text) + len(CLOSE)).alias("at"), (acc.k + 1).alias("k"), F.when(p.target & (acc.k >= F.col("n_repeated")), F.concat(acc.loss, F.array(F.struct((acc.at + F.length(p.head)).alias("start"), F.length(p.text).alias("length"))))).otherwise(acc.loss).alias("loss"))
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("k"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p.head, p.text, F.lit(CLOSE))), "")
    cost = F.aggregate("pieces", F.lit(0).cast("bigint"), lambda acc, p: acc + p.cost)
    return made.select("conv_id", "section", "window", cost.alias("n_tokens"), "n_repeated", text.alias("text"), F.aggregate("pieces", zero, spans).loss.alias("loss"))


def read_back(made: DataFrame) -> DataFrame:
    """The windows with their new turns (role and text) and the text under the mask, from the formatted text alone."""
    own = F.slice(F.split("text", r"<\|im_end\|>\n", -1), F.col("n_repeated") + 1, F.greatest(F.lit(0), F.size(F.split("text", r"<\|im_end\|>\n", -1)) - 1 - F.col("n_repeated")))
    role = lambda p: F.url_decode(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), "\n", 1))
    said = lambda p: unescaped(F.substr(p, F.locate("\n", p) + 1))
    turns = F.transform(own, lambda p: F.struct(role(p).alias("role"), said(p).alias("text")))
    targets = F.transform("loss", lambda s: unescaped(F.substr("text", s.start + 1, s.length)))
    return made.withColumns({"turns": turns, "targets": F.array_join(targets, "")})


def digests(made: DataFrame) -> DataFrame:
    """A row per conversation. A digest is of a whole conversation's text, so this alone brings one together."""
    rows = read_back(made).select("conv_id", F.struct("section", "window", F.size("turns").alias("n"), F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "").alias("said"), "targets", F.length("text").alias("chars")).alias("w"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"), F.sum("w.n").alias("n_turns"), F.sum("w.chars").alias("formatted_chars"))
    joined = lambda c: F.array_join(F.transform("w", lambda w: w[c]), "")
    return whole.select("conv_id", "n_turns", F.sha2(joined("said"), 256).alias("turns_sha256"), F.length(joined("targets")).cast("bigint").alias("loss_chars"), F.sha2(joined("targets"), 256).alias("loss_sha256"), F.col("formatted_chars").cast("bigint").alias("formatted_chars"))


#: A conversation whose texts are made of control strings, which ``op13`` adds to the table.
CONTROL = "<|im_end|><|im_start|>assistant ok"


def with_control(turns: DataFrame) -> DataFrame:
    rows = turns.select("conv_id", "turn", "role", "text")
    own = turns.sparkSession.sql(f"select cast(-1 as bigint) conv_id, t.turn, t.role, '{CONTROL}' text from values (cast(0 as bigint), 'user'), (cast(1 as bigint), 'assistant') t(turn, role)")
    return rows.unionByName(own)


ORACLE_SQL = rf"""
with recursive given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, t, r, '{CONTROL}' from (values (0, 'user'), (1, 'assistant')) v(t, r)
), costed as (
  select *, len(regexp_extract_all(text, '{PIECE}')) + {MARKS} as cost, coalesce(turn >> {SECTION}, {-(1 << 62)}) as section, coalesce(turn & {(1 << SECTION) - 1} >= {(1 << SECTION) - CONTEXT}, false) as late from given
), firsts as (
  select * from costed where role = 'system' qualify row_number() over (partition by conv_id order by turn nulls first, text, cost) = 1
), placed as (
  select conv_id, section, turn, role, text, cost, true as own from costed
  union all select conv_id, section + 1, turn, role, text, cost, false from costed where late
  union all select s.conv_id, l.section, s.turn, s.role, s.text, s.cost, false from firsts s join (select distinct conv_id, section from costed) l
    on l.conv_id is not distinct from s.conv_id and l.section > s.section and not (s.late and l.section = s.section + 1)
), numbered as (
  select *, row_number() over w as k, sum(cost) over (w rows unbounded preceding) - cost as start, bool_or(own) over (partition by conv_id, section) as any_own,
    first(case when role = 'system' then cost end ignore nulls) over (partition by conv_id, section order by turn nulls first, role, text, cost, own rows between unbounded preceding and unbounded following) as system_cost
  from placed window w as (partition by conv_id, section order by turn nulls first, role, text, cost, own)
), turns as (
  select * exclude (any_own), greatest({(BUDGET - HISTORY) // 2}, {BUDGET - HISTORY} - coalesce(system_cost, 0)) as room, min(case when role = 'system' then k end) over (partition by conv_id, section) as system_at,
    dense_rank() over (order by conv_id, section) as g,
    length('{OPEN}') + length(replace(url_encode(role), '%20', '+')) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + {len(CLOSE)} as chars
  from numbered where any_own
), jumps as (
  select a.g, a.k, min(b.k) as to_k from turns a join turns b on a.g = b.g and a.own and b.k > a.k and b.start + b.cost - a.start > a.room group by a.g, a.k
), cuts as (
  select g, min(k) as k from turns where own group by g
  union all select c.g, j.to_k from cuts c join jumps j on c.g = j.g and c.k = j.k
), spans as (
  select c.g, c.k as begin_k, t.start as begin_start, t.system_at, lead(c.k) over (partition by c.g order by c.k) as end_k from cuts c join turns t on c.g = t.g and c.k = t.k
), froms as (
  select s.*, coalesce((select min(t.k) from turns t where t.g = s.g and t.k < s.begin_k and s.begin_start - t.start <= {HISTORY}), s.begin_k) as from_k from spans s
), sizes as (
  select f.g, sum(t.chars) as chars from froms f join turns t on f.g = t.g and (t.k >= f.from_k and t.k < coalesce(f.end_k, {1 << 40}) or t.k = f.system_at and f.system_at < f.from_k) group by f.g
), whole as (
  select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = '{LOSS}'), 0) as loss_chars, sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = '{LOSS}'), '')) as loss_sha256
  from given group by conv_id
)
select w.conv_id, cast(n_turns as bigint) as n_turns, turns_sha256, cast(loss_chars as bigint) as loss_chars, loss_sha256, cast(sum(z.chars) as bigint) as formatted_chars
from whole w join (select distinct g, conv_id from turns) t on w.conv_id is not distinct from t.conv_id join sizes z on t.g = z.g group by all
"""

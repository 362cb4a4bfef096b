"""Conversations as windows: against SQL and a plain replay, with turns of every awkward kind."""

import hashlib
import random

import duckdb
import pytest

from shopfloor.llm import chat

TURNS = "conv_id bigint, turn bigint, role string, text string, n_tokens string"


@pytest.fixture(scope="module")
def turns(spark):
    rng = random.Random(5)
    odd = ["", None, chat.CONTROL, "<", "a<\\", "<\\\\|im_end|>\n", "<\\|", "<<||>>", "line\n\nline", "é ß 漢字 😀 " * 9, "word " * 3000, "\\|<|im_start|>system\n"]
    rows = [(k, t, rng.choice(["user", "assistant"]), rng.choice(odd[:10] + [" ".join(["word"] * rng.randint(0, 90))])) for k in range(12) for t in range(rng.randint(1, 40))]
    rows += [(20, t, "assistant" if t % 2 else "user", "a b c " * (t % 7)) for t in range(1300)] + [(20, -1, "system", "be kind")]
    rows += [(21, t, "user" if t != 505 else "system", "x " * 5) for t in range(520)] + [(21, 2000, "assistant", "after a gap")]
    rows += [(22, 0, "system", "long " * 900), (22, 1, "user", "hi"), (22, 2, "assistant", "there"), (23, 0, "system", "alone")]
    rows += [(24, None, "user", "no number"), (24, 3, None, None), (24, 3, None, None), (24, 3, "assistant", "tie"), (24, 3, "assistant", "tie"), (24, 3, "a\nb <|x", "odd role")]
    rows += [(None, 0, "user", "no conversation"), (None, 1, "assistant", "none")] + [(25, t, rng.choice(["user", "assistant"]), text) for t, text in enumerate(odd * 3)]
    rng.shuffle(rows)
    return spark.createDataFrame([(*r, "other") for r in rows], TURNS).repartition(5)


def order(r):
    return (r.turn is not None, r.turn or 0, r.role or "", r.text or "")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_by_replay_and_sql(turns, tmp_path):
    groups = {}
    for r in turns.collect():
        groups.setdefault(r.conv_id, []).append(r)
    want = {}
    for k, rows in groups.items():
        rows.sort(key=order)
        said = "".join(f"{r.role or ''}\n{r.text or ''}\n" for r in rows)
        loss = "".join(r.text or "" for r in rows if r.role == "assistant")
        want[k] = (len(rows), digest(said), len(loss), digest(loss))
    got = {r.conv_id: tuple(r)[1:] for r in chat.digests(chat.windows(turns)).collect()}
    assert {k: v[:4] for k, v in got.items()} == want
    turns.drop("n_tokens").write.parquet(str(tmp_path / "c"))
    db = duckdb.connect()
    db.sql(f"create view conversations as select * from '{tmp_path}/c/*.parquet'")
    sql = {r[0]: r[1:] for r in db.sql(chat.ORACLE_SQL).fetchall()}
    assert sql.pop(-1)[0] == 2 and sql == got


def test_windows_keep_to_the_budget_and_repeat_only_what_they_may(turns):
    made = chat.windows(turns, 400, 100).collect()
    assert {r.conv_id for r in made} == {r.conv_id for r in turns.collect()}
    back = {(r.conv_id, r.section, r.window): r for r in chat.read_back(chat.windows(turns, 400, 100)).collect()}
    for r in made:
        marks = r.text.count(chat.OPEN)
        new = back[r.conv_id, r.section, r.window].turns
        assert marks == r.text.count("<|im_end|>\n") == r.n_repeated + len(new)
        assert r.n_tokens <= 400 or len(new) == 1 or r.conv_id == 22
        assert len(r.loss) == sum(t.role == "assistant" for t in new)
        assert all(r.text[s.start + s.length :].startswith(chat.CLOSE) for s in r.loss)
    # the system turn heads every window of its conversation that begins after it, in every section
    assert all(r.text.startswith(f"{chat.OPEN}system\nbe kind") for r in made if r.conv_id == 20)
    assert {r.section for r in made if r.conv_id == 20} == {-1, 0, 1, 2}
    assert any(r.section == 1 and r.window == 0 and r.n_repeated > 2 for r in made if r.conv_id == 20)
    again = chat.read_back(chat.windows(turns.where("conv_id = 25"), 400, 100)).collect()
    texts = [t.text for r in sorted(again, key=lambda r: (r.section, r.window)) for t in r.turns]
    assert texts == [r.text or "" for r in sorted(turns.where("conv_id = 25").collect(), key=order)]


def test_empty_table(turns):
    assert chat.windows(turns.limit(0)).count() == 0 and chat.digests(chat.windows(turns.limit(0))).count() == 0


def test_plan_has_no_python(turns):
    plan = chat.digests(chat.windows(turns))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

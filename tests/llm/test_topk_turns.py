"""Queries meet the index a bounded number at a time; no copies of blocks or queries are made for each other."""

import numpy as np
from pyspark.sql import functions as F

from shopfloor.llm import topk


def test_queries_go_in_turns(spark, monkeypatch):
    v = np.random.default_rng(2).normal(size=(300, 5))
    v[100:140] = v[7]  # ties, also across tasks
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], "vec_id bigint, embedding array<double>")
    turns, sent = [], []
    store, broadcast = topk.stored, F.broadcast
    monkeypatch.setattr(topk, "stored", lambda made, *more: turns.append(made) or store(made, *more))
    monkeypatch.setattr(topk.F, "broadcast", lambda d: sent.append(d.select(F.sum(F.size("asked"))).first()[0]) or broadcast(d))
    monkeypatch.setattr(topk, "AT_ONCE", 8 * 5 * 16)
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, df.where("vec_id % 7 = 0"), 4, 16, 8).collect())
    q = np.floor(v * 1024).astype(int)
    want = []
    for i in range(0, 300, 7):
        s = q @ q[i]
        order = sorted((k for k in range(300) if k != i), key=lambda k: (-s[k], k))[:4]
        want += [(i, n + 1, k, int(s[k])) for n, k in enumerate(order)]
    assert got == sorted(want)
    assert len(turns) == 3 and sum(x or 0 for x in sent) == 43 and max(x or 0 for x in sent) < 43
    assert all("Generate explode" not in t._jdf.queryExecution().executedPlan().toString() for t in turns)

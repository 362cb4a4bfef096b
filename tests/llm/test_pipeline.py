"""The pipeline's stages: columns, order, and that each decision takes effect."""

from pyspark.sql import functions as F

import corpus_pipeline
from shopfloor.llm import decontaminate, neardup, packing, quality
from shopfloor.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        seen.append((docs, out))
        docs = out
    assert all(o.columns == columns for _, o in seen[:-1])
    before, after = seen[0]
    model = quality.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert sorted(r.doc_id for r in after.collect()) == sorted(r.doc_id for r in quality.score(before, model).where("predicted = 1").collect())
    assert seen[1][0].count() == seen[1][1].count()
    assert neardup.near_duplicates(seen[2][1]).where("not kept").count() == 0
    assert seen[2][1].count() == neardup.near_duplicates(seen[2][0]).where("kept").count()
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontaminate.contaminated(seen[3][1], items).count() == 0
    assert {r.doc_id for r in seen[4][1].collect()} == {r.doc_id for r in seen[3][1].collect()}
    total = seen[4][1].groupBy("doc_id").sum("length").collect()
    assert len(total) == seen[3][1].count() and packing.MOST == 4096


def test_stages_on_edge_cases(spark):
    words = " ".join(f"w{k}" for k in range(60))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 40").first().text
    rows = [(1, None), (2, ""), (3, " \n\t "), (None, words), (4, words), (5, words), (6, "again and again the same"), (6, "again and again the same"), (7, f"before {item} after"), (8, " ".join(f"x{k * k % 9973}" for k in range(300_000)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(3) for c in ("score", "predicted", "n_dropped", "_0", "_key", "bad_id", "kept", "key", "start", "label")})
    ids = lambda df: sorted((r.doc_id or 0) for r in df.select("doc_id").collect())
    out = {name: stage(spark, docs, SF) for name, stage in corpus_pipeline.STAGES}
    assert all(out[name].columns == docs.columns for name, _ in corpus_pipeline.STAGES[:-1])
    assert set(ids(out["quality classifier"])) <= {0, *range(1, 9)} and {1, 2, 3} <= set(ids(out["quality classifier"]))
    assert ids(out["line dedup"]) == [0, 1, 2, 3, 4, 5, 6, 6, 7, 8] and out["line dedup"].where("doc_id = 1").first().text is None
    assert ids(out["near-dedup"]) == [0, 1, 2, 3, 4, 6, 6, 7, 8]
    assert ids(out["decontamination"]) == [0, 1, 2, 3, 4, 5, 6, 6, 8]
    assert set(ids(out["packing"])) == {0, *range(1, 9)}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0, name

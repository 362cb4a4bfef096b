"""Python gets large rows in small batches."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from shopfloor.llm import common, neardup, suffixes


def test_stored_hands_few_rows_at_once(spark):
    before = spark.conf.get(common.HANDED)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64())], names=["n"])

    out = common.stored(spark.range(0, 3000, 1, 1).mapInArrow(sizes, "n bigint"), "sizes", neardup.WIDE)
    assert out.agg(F.max("n"), F.sum("n")).first()[:] == (neardup.WIDE, 3000)
    assert spark.conf.get(common.HANDED) == before


def test_suffix_sort_looks_at_few_phrases_at_once(monkeypatch):
    """Python's arrays and what it hands back are as large as a part, not as a batch, and say the same."""

    class Batches:
        def mapInArrow(self, run, schema):
            return run

    rng, texts = np.random.default_rng(3), 40
    names = [rng.integers(1, 9, 50).tolist() for _ in range(texts)]
    own = [[{"j": j, "row": 7} for j in range(0, 50, 5)] for _ in range(texts)]
    most = [[{"j": 5, "most": 20}] if k % 2 else None for k in range(texts)]
    columns = {"key": pa.array(range(texts), pa.int64()), "at": pa.array([list(range(0, 51 * 60, 60))] * texts, pa.list_(pa.int32())), "names": pa.array(names, pa.list_(pa.int64())), "own": pa.array(own), "t": pa.array([[{"j": 1, "name": 5}]] * texts), "x": pa.nulls(texts), "most": pa.array(most)}
    batch = pa.RecordBatch.from_pydict(columns)
    for make in (lambda: suffixes.triples(Batches(), 0), lambda: suffixes.orders(Batches())):
        monkeypatch.setattr(suffixes, "PHRASES", 1 << 20)
        whole = list(make()(iter([batch])))
        monkeypatch.setattr(suffixes, "PHRASES", 200)
        few = list(make()(iter([batch])))
        assert len(whole) == 1 and len(few) == texts // 4
        order = [(c, "ascending") for c in whole[0].schema.names]
        assert pa.Table.from_batches(few).sort_by(order) == pa.Table.from_batches(whole).sort_by(order)

"""Every query with SQL against DuckDB, and entry points."""

import math
import os
import shutil
import subprocess
import sys
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


def plain(v):
    if isinstance(v, (float, Decimal)):
        return None if math.isnan(v) else round(float(v), 6)
    return v


def rows(columns, found):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = entry_points.queries()[name](spark, str(DATA))
    rel = db.sql(entry_points.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, df.collect()) == rows(rel.columns, rel.fetchall())


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("gone", [("shopfloor/llm", "tests/llm"), ("shopfloor/llm", "tests/llm", "corpus_pipeline.py")])
def test_the_rest_stands_without_the_training_data_operators(tmp_path, gone):
    root = Path(entry_points.__file__).parent
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache"))
    for name in gone:
        shutil.rmtree(copy / name, ignore_errors=True)
        (copy / name).unlink(missing_ok=True)
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert q and set(o) <= set(q) and 'pipeline' not in q and not any(n.startswith('op1') for n in q)"
    env = {**os.environ, "PYTHONPATH": f"{copy}:{os.environ.get('PYTHONPATH', '')}"}
    for command in (["-c", code], ["-m", "pytest", "--collect-only", "-q", "tests"]):
        done = subprocess.run([sys.executable, *command], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stdout + done.stderr

"""The tokenizers library starts no threads of its own inside a task."""

import subprocess
import sys
from pathlib import Path

import pytest

pytest.importorskip("public_tokenizers")
CODE = """
import os
from shopfloor.llm import tokens
e = tokens.encoder("byte_bpe_50k.json")
before = len(os.listdir("/proc/self/task"))
e.encode([f"word{i} and more{i}" for i in range(2000)])
print(len(os.listdir("/proc/self/task")) - before)
"""


def test_encoding_starts_no_threads():
    env = {"PATH": "/usr/bin:/bin", "PYTHONPATH": ":".join(p for p in sys.path if p)}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=Path(__file__).parents[2], env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert done.stdout.strip() == "0"

"""Pieces of text are found without Python's regular expressions; new ones go to the library's model alone, and get the ids
that the library gives."""

import re
from types import SimpleNamespace

import numpy as np
import pytest

pytest.importorskip("public_tokenizers")
from shopfloor.llm import tokens  # noqa: E402

SIGNS = "\n\t\r" + "".join(map(chr, range(32, 127))) + "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))


def test_pieces_skip_the_librarys_pipeline():
    made = tokens.Encoder(tokens.public_path("byte_bpe_50k.json"))
    library, made.library = made.library, SimpleNamespace(model=made.library.model)
    made.split = None
    rng = np.random.default_rng(5)
    texts = ["", " ", "I'll go\r\n\r\n  ''s 12 34", *SIGNS, *("".join(rng.choice(list(SIGNS), n)) for n in range(200))]
    ids, counts = made.encode(texts)
    whole = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == [len(x) for x in whole]
    assert ids.tolist() == [i for x in whole for i in x]


def test_pieces_start_where_the_pattern_says():
    rng, some = np.random.default_rng(6), ["'", "'", "s", "t", "ll", "ve", "re", "r", " ", " ", "\n", "\t", "a", "é", "7", "!", "S"]
    texts = ["", *("".join(rng.choice(some if n % 2 else list(SIGNS), n % 23)) for n in range(6000)), "'", "x'", "'s", "'r", "e", "'ve"]
    raw = [t.encode() for t in texts]
    off = np.cumsum([0, *map(len, raw)])
    start = tokens.starts(np.frombuffer(b"".join(raw), np.uint8), off)
    want = [off[k] + len(t[: m.start()].encode()) for k, t in enumerate(texts) for m in re.finditer(tokens.BYTE_LEVEL, t)]
    assert start.tolist() == want
    assert tokens.starts(np.zeros(0, np.uint8), np.zeros(3, np.int64)).tolist() == []

"""Token ids of whole texts by the tokenizers library, with each distinct piece of text encoded once.

The library splits a text into pieces by a fixed pattern and encodes every piece by itself. Workers keep the ids of
pieces they have met, so the library's merges run once per piece, not once per occurrence. Texts with characters for
which the split below is not known to equal the library's, and those that hold an added token, go to the library whole.
"""

from __future__ import annotations

import codecs
import functools
import json
import os
import re
from itertools import chain, islice

import numpy as np
import pyarrow as pa

from shopfloor.llm import common

# Letters of the plain alphabet, and the split patterns of the two public vocabularies over it.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
OTHER = re.compile(f"[^\\n\\t\\r\\x20-\\x7e{LETTERS[6:]}]")
# (letters first: they are most of a text, and no other alternative starts with one)
SHORT = "'(?:[stmd]|re|ve|ll)"
#: ``starts`` finds what this finds; tests hold one against the other.
BYTE_LEVEL = f" ?[{LETTERS}]+| ?[0-9]+|{SHORT}| ?[^\\s{LETTERS}0-9]+|\\s+(?!\\S)|\\s+"
WORD_LEVEL = f"[{LETTERS}]+|[0-9]|{SHORT}|[^\\s{LETTERS}0-9]+"

#: The character that byte-level vocabularies write for each byte: itself if it is visible, else one from 256 on.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
SIGNS = "".join(chr(b if b in SHOWN else 256 + b - sum(p < b for p in SHOWN)) for b in range(256))

#: The kind of each byte of plain text: white space, letter (all that isn't ASCII), digit, other.
KIND = np.full(256, 3, np.uint8)
KIND[[9, 10, 13, 32]] = 0
KIND[65:91] = KIND[97:123] = KIND[128:] = 1
KIND[48:58] = 2

#: Bytes that the pieces a worker keeps may take, with ABOUT for each beside its text; past this it forgets the later half,
#: for the pieces that are met first are the common ones.
KEPT, ABOUT = 192 << 20, 340


def public_path(name: str) -> str:
    """Where a public vocabulary lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the byte-level pieces of plain texts start; the bytes of all texts in one array, and their bounds."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    kind, first = KIND[data], np.zeros(n + 1, bool)
    first[off] = True  # of a text
    start = first.copy()
    start[1:n] |= kind[1:] != kind[:-1]
    # the last white space before something else goes apart, and takes that in if it is a blank
    white = kind == 0
    last = np.flatnonzero(white[:-1] & ~white[1:] & ~first[1:n])
    start[last] = True
    start[last[data[last] == 32] + 1] = False
    # 's and the like, where they start a piece
    more = np.concatenate([data, np.zeros(2, np.uint8)])
    at = np.flatnonzero(start[:n] & (data == 39))
    at = at[~first[at + 1]]
    one = at[np.isin(more[at + 1], np.frombuffer(b"stmd", np.uint8))]
    pair = more[at + 1].astype(np.uint16) << 8 | more[at + 2]
    two = at[np.isin(pair, np.frombuffer(b"revell", ">u2").astype(np.uint16))]
    two = two[~first[two + 2]]
    start[np.concatenate([one, two]) + 1] = False
    start[one + 2] = start[two + 3] = True
    return np.flatnonzero(start[:n])


class Slots(dict):
    """Numbers pieces in the order in which they are first asked for."""

    def __init__(self):
        super().__init__()
        self.new: list[str] | list[bytes] = []
        self.size = 0

    def __missing__(self, piece: str | bytes) -> int:
        self[piece] = at = len(self)
        self.new.append(piece)
        self.size += len(piece) + ABOUT
        return at


class Encoder:
    def __init__(self, path: str):
        # a task has one core; the library's threads would wait for each other at others' cost
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        kind = made["pre_tokenizer"]["type"]
        self.lower = made["normalizer"] is not None
        # in any case of letters, as the library may look for a token in the lower-cased text
        added = "|".join(re.escape(x["content"]) for x in made.get("added_tokens") or [] if x["content"])
        self.added = re.compile(added or "(?!)", re.IGNORECASE)
        self.bytes = kind == "ByteLevel" and made["normalizer"] is None
        self.split = re.compile(WORD_LEVEL if kind == "Sequence" else BYTE_LEVEL).findall
        self._fresh()

    def _fresh(self) -> None:
        self.slot = Slots()
        self.ids = np.zeros(1 << 18, np.uint32)
        self.off = np.zeros(1 << 16, np.int64)  # slot k: ids[off[k] : off[k + 1]]

    def _forget(self) -> None:
        few, self.slot = islice(self.slot.items(), len(self.slot) // 2), Slots()
        self.slot.update(few)
        self.slot.size = sum(map(len, self.slot)) + ABOUT * len(self.slot)

    def _learn(self) -> None:
        new, self.slot.new = self.slot.new, []
        if not new:
            return
        found = self._modelled(new) if self.bytes else [e.ids for e in self.library.encode_batch_fast(new, add_special_tokens=False)]
        lens = np.fromiter(map(len, found), np.int64, len(found))
        at, n = len(self.slot) - len(new), int(lens.sum())
        while len(self.slot) + 1 > len(self.off):
            self.off = np.concatenate([self.off, np.zeros_like(self.off)])
        while self.off[at] + n > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.off[at + 1 : len(self.slot) + 1] = self.off[at] + np.cumsum(lens)
        self.ids[self.off[at] : self.off[at] + n] = np.fromiter(chain.from_iterable(found), np.uint32, n)

    def _modelled(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids by the library's model alone, which takes pieces in signs; splitting them once more and making whole results of
        them costs it two thirds of its time."""
        tokenize = self.library.model.tokenize
        signs, _ = codecs.charmap_decode(b"\0".join(pieces), "strict", SIGNS)  # no plain text has \0
        return [[t.id for t in tokenize(s)] for s in signs.split(SIGNS[0])]

    def _word_slots(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The slots of the pieces of plain texts, and how many each text has."""
        pieces = [self.split(t.lower() if self.lower else t) for t in texts]
        counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
        return np.fromiter(map(self.slot.__getitem__, chain.from_iterable(pieces)), np.int64, int(counts.sum())), counts

    def _byte_slots(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same; Python meets each distinct piece once, and Arrow the others."""
        data, off = common.buffers(pa.array(texts, pa.large_string()))
        start = starts(data, off)
        bounds = np.append(start, len(data))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        slots = np.fromiter(map(self.slot.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False).tolist()), np.int64, len(pieces.dictionary))
        return slots[pieces.indices.to_numpy()], np.diff(np.searchsorted(start, off))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and how many each text has."""
        if self.slot.size > KEPT:
            self._forget()
        plain = [OTHER.search(t) is None and self.added.search(t) is None for t in texts]
        slots, counts = (self._byte_slots if self.bytes else self._word_slots)([t if p else "" for t, p in zip(texts, plain, strict=True)])
        self._learn()
        lens = self.off[slots + 1] - self.off[slots]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(self.off[slots] - (ends - lens), lens) + np.arange(total)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        if all(plain):
            return ids, np.diff(bounds)
        rest = iter([np.array(e.ids, np.uint32) for e in self.library.encode_batch_fast([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False)])
        parts = [ids[bounds[i] : bounds[i + 1]] if p else next(rest) for i, p in enumerate(plain)]
        return np.concatenate(parts), np.fromiter(map(len, parts), np.int64, len(parts))


@functools.lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One per worker and vocabulary: a file path, or the name of a public vocabulary."""
    return Encoder(vocabulary if "/" in vocabulary else public_path(vocabulary))

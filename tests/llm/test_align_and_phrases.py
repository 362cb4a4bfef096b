"""Token alignment and phrases against plain counting, with texts of every awkward kind."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shopfloor.llm import align, phrases, tokens

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, n bigint, phrase string, words string"


def odd(rng):
    texts = [None, "", " ", "a", "  two  spaces\t tab ", "▁ a▁b", "<|endoftext|> <s> </s>", "é ß ﬁ Ⅳ １ 漢字 😀 👩‍👩‍👧", "\0 \x01 control", "the the the", "the the the", "x" * 3000, "word " * 4000, "line\r\nbreak\n\n\nend"]
    return texts + ["".join(rng.choice("abc é▁<|>\n 12 the") for _ in range(rng.randint(1, 300))) for _ in range(40)]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    rows = [(None if k % 17 == 5 else k // 2, t, rng.choice(["en", None, "und", "fr"]), 3, "p", "w") for k, t in enumerate(odd(rng))]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def by_hand(rows):
    a, b = Tokenizer.from_file(tokens.public_path(align.BYTES)), sentencepiece.SentencePieceProcessor(model_file=tokens.public_path(align.PIECES))
    a.encode_special_tokens = True
    letter, out, pairs = align.byte_alphabet(), [], Counter()
    for doc, text in rows:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        raw = [bytes(letter[c] for c in a.id_to_token(i)) for i in ids_a]
        said = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not text or not b"".join(raw) == b"".join(said) == (" " + text).encode():
            out.append((doc, 0, 0, 0, [], ""))
            continue
        spans = lambda parts: [(e - len(p), e) for p, e in zip(parts, np.cumsum([len(p) for p in parts]).tolist(), strict=True)]
        sa, sb = spans(raw), spans(said)
        links = [(i, j) for (s, e), i in zip(sa, ids_a, strict=True) for (u, v), j in zip(sb, ids_b, strict=True) if s < v and u < e]
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, start = [], 0
        for end in ends:
            side = lambda sp, ids: ",".join(str(i) for (s, e), i in zip(sp, ids, strict=True) if start < e <= end)  # noqa: B023, E731
            groups.append(f"{side(sa, ids_a)}|{side(sb, ids_b)}")
            start = end
        pairs.update(links)
        out.append((doc, len(ids_a), len(ids_b), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (_, j), n in pairs.items():
        best[j] = max(best[j], n)
    return sorted(((d, na, nb, g, len(ls), sha, sum(pairs[x] == best[x[1]] for x in ls), sum(pairs[x] for x in ls)) for d, na, nb, g, ls, sha in out), key=repr)


@pytest.mark.parametrize("fan, slices", [(64, 1), (2, 12)])
def test_alignment_by_hand(docs, monkeypatch, fan, slices):
    """Also with so many slices, and so few runs a merge, that several rounds of merges are needed."""
    monkeypatch.setattr(align, "FAN", fan)
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.text is None or len(r.text) < 3500]
    short = docs.where("text is null or length(text) < 3500")
    got = align.alignments(short.repartition(slices)).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(rows)


def test_alignment_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    rows = [(r.doc_id, r.text) for r in docs.collect() if len(r.text) < 6000]
    got = align.alignments(docs.where("length(text) < 6000")).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(rows)


def test_merged_runs_add_up():
    rng = np.random.default_rng(1)
    want, runs = Counter(), []
    for _ in range(9):
        keys = np.unique(rng.integers(0, 400, 150))
        counts = rng.integers(1, 9, len(keys))
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        size = int(rng.integers(1, 40))
        runs.append(iter([(keys[k : k + size], counts[k : k + size]) for k in range(0, len(keys), size)]))
    got = [(k, n) for keys, counts in align.merged(runs) for k, n in zip(keys.tolist(), counts.tolist(), strict=True)]
    assert got == sorted(want.items())


def test_runs_survive_packing():
    keys = np.cumsum(np.random.default_rng(2).integers(1, 1 << 30, 200_000))
    back = list(align.chunks(align.run(keys, keys % 7)))
    assert len(back) > 1 and (np.concatenate([k for k, _ in back]) == keys).all() and (np.concatenate([c for _, c in back]) == keys % 7).all()


def test_empty_tables(docs):
    assert align.alignments(docs.limit(0)).count() == 0 and phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.where("text is null")).count() == 0


def plain_phrases(rows, least, cover, top):
    f = defaultdict(Counter)
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\\x0A-\\x0D]", low):
            w = re.findall("[^\\x20\\x09]+", piece)
            for n in range(1, 6):
                f[lang or "und"].update(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for k, v in c.items() if len(k) == 1)
        long_ = {k: v for k, v in c.items() if len(k) > 1 and v >= least}
        inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        kept = [p for p, a in long_.items() if not any(len(q) > len(p) and 100 * v >= cover * a and inside(p, q) for q, v in long_.items())]
        best = []
        for p in kept:
            score, k = min(((1000 * c[p] * n) // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -c[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, x[2].decode(), -x[1], x[3], x[4], n, -x[0]) for i, x in enumerate(sorted(best)[:top], 1)]
    return sorted(out)


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@pytest.mark.parametrize("least, cover, top", [(3, 100, 2000), (5, 60, 10), (2, 100, 50)])
def test_phrases_by_plain_counting(spark, docs, least, cover, top):
    rng = random.Random(8)
    vocabulary = ["a", "bé", "C", "d\x01", "d", "e.", "f, g", "\tx"]
    rows = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60))), rng.choice(["en", None, "und"]), 0, "", "") for k in range(60)]
    both = docs.unionByName(spark.createDataFrame(rows, DOCS))
    got = phrases.collocations(both, least, cover, top).select(*COLUMNS)
    assert sorted(map(tuple, got.collect())) == plain_phrases([(r.text, r.lang) for r in both.collect()], least, cover, top)


def test_phrases_by_sql_beyond_64_bits(spark, tmp_path):
    """One text that many documents share, over several partitions."""
    docs = spark.range(700).selectExpr("id as doc_id", "'Of the people, by the people; of The\tpeople shall not perish' as text", "'en' as lang").repartition(7)
    docs.write.parquet(str(tmp_path / "d"))
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{tmp_path}/d/*.parquet'")
    want = db.sql(f"select {', '.join(COLUMNS)} from ({phrases.ORACLE_SQL})").fetchall()
    got = phrases.collocations(docs).select(*COLUMNS)
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
    big = spark.range(1).selectExpr("cast(900000000000 as bigint) a", "cast(90000000000000 as bigint) n", "cast(900000000001 as bigint) l", "cast(950000000000 as bigint) r")
    exact = big.select(phrases.score(*(big[c] for c in "anlr")).alias("s")).first().s
    assert exact == 1000 * 900000000000 * 90000000000000 // (900000000001 * 950000000000)

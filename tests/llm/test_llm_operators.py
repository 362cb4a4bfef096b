"""Each operator against brute force or exact round trips, on edge cases and small frames."""

import hashlib
import math
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shopfloor.llm import common, decontaminate, licenses, linededup, maintext, neardup, packing, quality, suffixes, tokenfile, tokens, topk

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, None, "s", None) for i, t in texts], DOCS)


@pytest.fixture(scope="module")
def edge(spark):
    """Null and empty texts, null ids, repeated rows, one very long text, and columns with the operators' own names."""
    rng = random.Random(3)
    texts = [(1, None), (2, ""), (3, "  \n\t "), (None, words(rng, 30)), (4, words(rng, 40)), (4, None), (5, words(rng, 6000)), (6, "same text here again and again"), (6, "same text here again and again"), (7, "É ß — 漢字 😀 " * 5)]
    return frame(spark, texts).withColumns({"score": F.lit(9), "key": F.lit("k"), "n": F.lit(1)})


OPERATORS = {
    "line": lambda d: linededup.deduplicate(d),
    "license": licenses.scan,
    "quality": lambda d: quality.score(d, quality.Model(np.zeros(quality.BUCKETS, np.float32), 0.0)),
    "pack": packing.pack,
    "near": neardup.near_duplicates,
    "file": tokenfile.token_file,
    "suffix": suffixes.deduplicate,
    "clean": lambda d: decontaminate.clean(d, d.select(F.col("doc_id").alias("item_id"), "text").where("doc_id = 6").distinct()),
}
ROWS = {"pack": None, "clean": 8}


@pytest.mark.parametrize("name", OPERATORS)
def test_edge_cases(spark, edge, name):
    n = OPERATORS[name](edge).count()
    assert ROWS.get(name, 10) in (None, n)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, edge, name):
    assert OPERATORS[name](edge.limit(0)).count() == 0


def test_line_templates_keep_the_first(spark):
    rng = random.Random(1)
    docs = frame(spark, [(k, f"{words(rng, 12)}\nposted on {k}-01-02 by the editor of the day\nshort line") for k in range(12)])
    got = {r.doc_id: r for r in linededup.deduplicate(docs).collect()}
    assert got[0].n_dropped == 0 and all(got[k].n_dropped == 2 and "posted" not in got[k].text for k in range(1, 12))


def test_decontamination_by_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    held = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if i.text in d.text}
    assert held <= got and len(got) <= len(held) + 1


def test_decontamination_scores_are_bm25(spark, monkeypatch):
    rng = random.Random(2)
    items = [(k, " ".join(rng.choice(("of", "the", "a", words(rng, 1))) for _ in range(rng.randint(5, 30)))) for k in range(60)]
    frame_of = spark.createDataFrame(items, "item_id bigint, text string")
    rows, stride = decontaminate.impacts(frame_of)
    index = decontaminate.build(rows.toArrow(), stride)
    own = [t.split() for _, t in items]
    df, mean = {}, sum(map(len, own)) / len(own)
    for w in own:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    k1, b = decontaminate.K1, decontaminate.B
    one = lambda w, t: math.log1p((len(own) - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) * (k1 + 1) / (w.count(t) + k1 * (1 - b + b * len(w) / mean))
    text = f"{words(rng, 70)} {items[7][1]} {words(rng, 90)} {items[9][1]} of the a of the a"
    said, w = text.split(), decontaminate.hashed_words(text)
    want = {}
    for at in range(0, len(said), stride):
        held = set(said[at : at + 2 * stride])
        for i, x in enumerate(own):
            score = sum(one(x, t) for t in set(x) & held) / sum(one(x, t) for t in set(x))
            if score >= decontaminate.LEAST:
                want[i, at] = score
    for cells in (decontaminate.CELLS, 1):
        monkeypatch.setattr(decontaminate, "CELLS", cells)
        got = {(index.ids[i], at): s for _, at, i, s in decontaminate.search(w, np.array([len(w)]), index)}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-5 for k in want) and {i for i, _ in got} >= {7, 9}


def test_decontamination_is_the_same_in_parts(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    extra = spark.createDataFrame([(9001, None), (9002, ""), (9003, "...")], "item_id bigint, text string").withColumn("doc_id", F.lit(1))
    items = items.unionByName(extra, allowMissingColumns=True)
    whole = {(r.doc_id, r.item_id, round(r.score, 6), r.first_word) for r in decontaminate.contaminated(docs, items).collect()}
    monkeypatch.setattr(decontaminate, "POSTINGS", 200)
    assert whole == {(r.doc_id, r.item_id, round(r.score, 6), r.first_word) for r in decontaminate.contaminated(docs, items).collect()}


def test_names_that_clash_stay(spark):
    docs = spark.createDataFrame([(k, f"{'x' * k} own\nthe same line stands here again") for k in range(12)], "doc_id bigint, text string")
    odd = docs.withColumns({c: F.lit(7) for c in ("_id", "_key", "_gone", "bad_id", "bad_key", "_0", "_1", "_2", "leaf", "n", "first", "item_id")})
    got = linededup.deduplicate(odd)
    assert got.columns[: len(odd.columns)] == odd.columns and got.where("_gone = 7 and _0 = 7").agg(F.sum("n_dropped")).first()[0] == 11
    items = spark.createDataFrame([(1, "the same line stands here again")], "item_id bigint, text string")
    assert decontaminate.clean(odd, items).count() == 0 and decontaminate.clean(odd, items.limit(0)).columns == odd.columns


@pytest.mark.parametrize("n", [300, 4000])
def test_a_template_is_one_at_every_size(spark, n):
    field = lambda f, k: F.concat(F.lit(f), F.chr(97 + (F.xxhash64("id", F.lit(f)) % 26 + 26) % 26), F.chr(97 + (F.xxhash64(F.lit(f), "id") % 26 + 26) % 26))
    line = F.concat(F.lit("posted in the section "), field("sec", 1), F.lit(" by our author "), field("aut", 2), F.lit(" on the site today"))
    docs = spark.range(n).select(F.col("id").alias("doc_id"), line.alias("text"))
    assert linededup.deduplicate(docs).agg(F.sum("n_dropped")).first()[0] == n - 1


def test_short_lines_recur(spark):
    many = linededup.deduplicate(frame(spark, [(k, "Menu") for k in range(10)] + [(10, None), (11, "one"), (12, "one")])).collect()
    assert sum(r.n_dropped for r in many) == 9


def test_item_split():
    assert decontaminate.question_and_answer("What is it?\nA stone.") == ("What is it?\n", "A stone.")
    assert decontaminate.question_and_answer("One. Two is.") == ("One. ", "Two is.")
    assert decontaminate.question_and_answer("Alone") == ("Alone", "")


def test_licenses_by_brute_force(spark):
    texts = ["Under the MIT License", "under the mit-license, UNDER THE MIT LICENSE", "cc by nc cc by nc", "cc by", "Apache License, Version 2.0", None, "é under the mit licenseé", "CC-BY-NC under the mit"]
    got = {r.doc_id: r for r in licenses.scan(frame(spark, list(enumerate(texts)))).collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for k, t in enumerate(texts):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(lower))
        at = {lab: [i for i in range(len(w)) if w[i : i + len(p.split())] == p.split()] for lab, p in licenses.BASE.items()}
        all_at = sorted(x for v in at.values() for x in v)
        r = got[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(all_at), *((all_at[0], all_at[-1]) if all_at else (None, None)))
        assert r.base_labels == ",".join(sorted(x for x in at if at[x])) and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}


def test_license_with_changed_words_is_found(spark):
    text = licenses.TEMPLATES[0][1].replace("of charge", "of any charge").replace("sublicense", "license")
    assert licenses.scan(frame(spark, [(1, text)])).first().labels == "mit"


def test_quality_learns_and_never_sees_held_out(spark):
    rng = random.Random(5)
    noisy = lambda t: " ".join(w + rng.choice(["!!", "###", "$$$"]) for w in t.split())
    texts = [(k, words(rng, 60) if k % 3 else noisy(words(rng, 60))) for k in range(300)]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(300)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).withColumn("held_out", quality.held_out()).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == int(r.doc_id % 3 > 0) for r in held]) > 0.95
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(model.odds, quality.fit(docs, flipped).odds)


def test_quality_of_held_out_documents_by_the_given_labels(spark):
    """All documents and labels of the table, and a floor for those whose labels were not learnt from."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.score(docs, quality.fit(docs, labels)).join(labels.select("doc_id", "quality"), "doc_id").where(quality.held_out()).select("score", "predicted", "quality").collect()
    good, bad = ([r for r in got if r.quality == y] for y in (1, 0))
    above = np.mean([(g.score > b.score) + (g.score == b.score) / 2 for g in good for b in bad])
    assert above > 0.9 and np.mean([r.predicted for r in good]) > 0.95 and np.mean([1 - r.predicted for r in bad]) > 0.5, (above, len(good), len(bad))


def test_quality_learns_from_every_feature_of_long_documents(spark):
    """Documents with more distinct words than any other part of training has rows for one text, told apart by a few."""
    rng = random.Random(8)
    texts = [(k, " ".join([*(f"w{rng.random()}" for _ in range(400)), *(["fine"] * 120 if k % 2 else ["poor"] * 120)])) for k in range(60)]
    docs = frame(spark, texts)
    model = quality.fit(docs, spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id bigint, quality int"))
    assert max(len(quality.document_features(t)[0]) for _, t in texts) > 1 << 13
    got = quality.score(docs, model).where(quality.held_out()).collect()
    assert got and np.mean([(r.score > 0.5) == bool(r.doc_id % 2) for r in got]) > 0.9


def test_quality_without_usable_labels_is_one_half(spark):
    """No labels, labels of one class, and labels that disagree for one doc_id; of repeated rows one is learnt from."""
    docs = frame(spark, [(k, f"text {k}") for k in range(20)] + [(1, "text 1"), (2, "another text")])
    kind = "doc_id bigint, quality int"
    for labels in ([], [(k, 1) for k in range(20)], [(k, y) for k in range(20) for y in (0, 1)], [(None, 1), (3, None), (4, 7)]):
        assert {r.score for r in quality.score(docs, quality.fit(docs, spark.createDataFrame(labels, kind))).collect()} == {0.5}


def test_quality_score_is_the_mean_of_embeddings(spark):
    rng = np.random.default_rng(0)
    model = quality.Model(rng.normal(size=quality.BUCKETS).astype(np.float32), 0.3)
    for text in ("one two two three", "x", ""):
        ids, share = quality.document_features(text)
        want = 1 / (1 + np.exp(-(float(share @ model.odds[ids]) + 0.3)))
        assert abs(quality.score(frame(spark, [(1, text)]), model).first().score - want) < 1e-5


@pytest.mark.parametrize("block,per", [(7, 3), (16, 4), (4096, 1024)])
def test_top_k_by_brute_force(spark, block, per):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(90, 6)).round(1)
    v[40:60] = v[3]  # ties
    v[61, 2], v[62, 0], v[63, 1], v[70, 3], v[71] = 1e7, -1e12, 3e6, 1e300, [1.7e308, -1e5, 0, 0, 0, 1]
    rows = [(int(i), [float(x) for x in row]) for i, row in enumerate(v)] + [(200, None), (201, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (202, [float("nan")] * 6), (203, [float("-inf")] * 6), (None, [1.0] * 6), (205, [1.0, 2.0]), (206, []), (207, []), (210, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({"id": F.lit(1), "v": F.lit("x"), "block": F.lit(3)})
    asked = df.where("vec_id % 10 = 0")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, asked.unionByName(asked), 5, block, per).collect())
    q = [[math.floor(Fraction(x) * 1024) for x in row] for row in v.tolist()]
    want = [(210, 1, 206, 0), (210, 2, 207, 0)]
    for i in range(0, 90, 10):
        s = [sum(a * b for a, b in zip(x, q[i], strict=True)) for x in q]
        order = sorted((k for k in range(90) if k != i), key=lambda k: (-s[k], k))[:5]
        want += [(i, n + 1, k, max(-(1 << 63), min((1 << 63) - 1, s[k]))) for n, k in enumerate(order)]
    assert got == sorted(want)
    assert topk.top_k(df.limit(0), asked).count() == 0 == topk.top_k(df, asked.limit(0)).count()


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    rows = packing.pack(docs).collect()
    library = tokens.encoder(packing.VOCABULARY).library
    for d in docs.collect():
        own = sorted((r for r in rows if r.doc_id == d.doc_id), key=lambda r: r.start)
        ids = [*library.encode(d.text or "", add_special_tokens=False).ids, packing.END]
        assert b"".join(bytes(r.ids) for r in own) == np.array(ids, "<u4").tobytes()
        assert all(r.length & (r.length - 1) == 0 and r.length <= 4096 and r.doc_tokens == len(ids) and r.offset == 0 for r in own)
        assert [r.start for r in own] == [sum(x.length for x in own[:k]) for k in range(len(own))]
    assert len({r.sequence_id for r in rows}) == len(rows)


def test_decompose():
    for n in (1, 2, 3, 4095, 4096, 4097, 12345):
        parts = packing.decompose(n)
        assert sum(parts) == n and parts == sorted(parts, reverse=True) and all(p & (p - 1) == 0 for p in parts)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_is_the_library(name):
    e = tokens.encoder(name)
    texts = ["", " a  b\tc\n\n d", "it's I'll 12ab ½ x²", "Á \x1c a", "İstanbul ß <|endoftext|> !!'s", "  a\r\n  b  ", "日本語 text 😀", "'t'test 'S's"]
    ids, counts = e.encode(texts)
    want = [e.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == [x for w in want for x in w] and counts.tolist() == [len(w) for w in want]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_with_added_tokens(name):
    library = Tokenizer.from_file(tokens.public_path(name))
    added = [x.content for x in library.get_added_tokens_decoder().values()]
    texts = ["plain text", *(f"a {x.upper()} b" for x in added), *(f"a {x} b{x}c" for x in added), "<|endoftext|>", "<|endoftext", "more plain text"]
    ids, counts = tokens.Encoder(tokens.public_path(name)).encode(texts)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert added and ids.tolist() == [x for w in want for x in w] and counts.tolist() == [len(w) for w in want]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_that_forgets_is_the_library(name, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 40_000)
    library, e, rng = Tokenizer.from_file(tokens.public_path(name)), tokens.Encoder(tokens.public_path(name)), random.Random(12)
    letters = "abcXYZ019 '\t\n.,-éßÀ€漢 "
    for _ in range(30):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(60)]
        ids, counts = e.encode(texts)
        want = [library.encode(x, add_special_tokens=False).ids for x in texts]
        assert ids.tolist() == [x for w in want for x in w] and counts.tolist() == [len(w) for w in want]
    assert len(e.slot) < 400


def test_html():
    page = """<body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav><div class="post-content"><h2>T&eacute;st</h2><p>First para with <a href=y>link</a> text, ok.<p>Second&nbsp;para
    of it.<ul><li>item one, short<li>item two</ul></div><div class="sidebar"><p>Popular posts here, read more.</p></div><section id="comments"><p>Great post, thanks! I liked it.</p></section>
    <form>Name <input><button>Go</button></form><script>var a="<p>no</p>";</script><footer>(c) 2020</footer></body>"""
    assert maintext.main_text(page) == "Tést\nFirst para with link text, ok.\nSecond para of it.\nitem one, short\nitem two"
    assert maintext.main_text(None) == maintext.main_text("") == maintext.main_text("<nav>only</nav>") == ""
    assert maintext.main_text("<p>broken <b>markup") == "broken markup"


def test_minimum_cut_by_brute_force():
    rng = random.Random(0)
    for _ in range(40):
        n = rng.randint(1, 7)
        source, sink = ([rng.randint(0, 9) for _ in range(n)] for _ in range(2))
        edges = [(a, b, rng.randint(1, 5)) for a in range(n) for b in range(a) if rng.random() < 0.5]
        cost = lambda side, n=n, source=source, sink=sink, edges=edges: sum(sink[i] if side >> i & 1 else source[i] for i in range(n)) + sum(c for a, b, c in edges if (side >> a & 1) != (side >> b & 1))
        kept = maintext.minimum_cut([float(x) for x in source], [float(x) for x in sink], edges)
        assert cost(sum(1 << i for i, k in enumerate(kept) if k)) == min(map(cost, range(1 << n)))


def test_html_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>Hello there, reader.</p></article>"), (2, None, None), (None, "u", "")], "page_id bigint, url string, html string").withColumn("text", F.lit("old"))
    got = {r.page_id: (r.text, r.n_chars) for r in maintext.extract(pages).collect()}
    assert got == {1: ("Hello there, reader.", 20), 2: ("", 0), None: ("", 0)}


def shingle_set(text):
    w = [x for x in re.split(r"[\x20\x09-\x0d]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_near_duplicates_by_brute_force(spark):
    rng = random.Random(4)
    texts = []
    for base in range(12):
        own = words(rng, 80).split()
        for _ in range(6):
            copy = list(own)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = words(rng, 1)
            texts.append(" ".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    texts += ["a b", "A  b", "a b c", "", None, " "]
    sets = [shingle_set(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i in range(len(texts)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    label[i] = label[j] = min(label[i], label[j])
    got = {r.doc_id: r for r in neardup.near_duplicates(frame(spark, list(enumerate(texts)))).collect()}
    assert [got[i].component_id for i in range(len(texts))] == label
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    assert all(got[i].kept == (label[i] == i) for i in range(len(texts)))


def test_near_duplicates_in_a_crowd(spark, monkeypatch):
    # texts at 0.726, so that all share regions, in pairs at 0.766; small blocks, so that regions have several
    monkeypatch.setattr(neardup, "BLOCK", 40, raising=False)
    rng = random.Random(5)
    base, texts = words(rng, 150), []
    for _ in range(150):
        pair = words(rng, 5)
        texts += [f"{base} {pair} {words(rng, 23)}" for _ in range(2)]
    sets = [shingle_set(t) for t in texts]
    assert all((len(a & b) >= 0.75 * len(a | b)) == (i // 2 == j // 2) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame(spark, list(enumerate(texts)))).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


def test_components(spark):
    chain = [(k, k + 1) for k in range(50)] + [(100, 101), (103, 101)]
    got = dict(map(tuple, neardup.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()))
    assert got == {k: 0 for k in range(51)} | {100: 100, 101: 100, 103: 100}


def test_wavelet_matrix():
    rng = np.random.default_rng(2)
    for n in (0, 1, 63, 64, 65, 3000):
        ids = rng.integers(0, 300, n).astype(np.uint32)
        m = tokenfile.WaveletMatrix.from_bytes(tokenfile.WaveletMatrix.build(ids).to_bytes())
        assert np.array_equal(m.ids(), ids)
        for i in rng.integers(0, max(n, 1), min(n, 20)).tolist():
            v = int(ids[i])
            assert m.access(i) == v and m.count(v, 0, i + 1) == int((ids[: i + 1] == v).sum())
            assert m.occurrence(v, int((ids[:i] == v).sum())) == i
        assert m.count(70000, 0, n) == 0 and m.occurrence(70000, 0) == -1


def test_token_file_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").repartition(5)
    got = sorted(tokenfile.read_shards(common.stored(tokenfile.write_shards(docs, shard=5000), "t")).collect())
    library, at = tokens.encoder(tokenfile.VOCABULARY).library, 0
    for r, d in zip(got, sorted(docs.collect()), strict=True):
        ids = np.array([*library.encode(d.text, add_special_tokens=False).ids, tokenfile.END], "<u4")
        assert (r.doc_id, r.start, bytes(r.ids)) == (d.doc_id, at, ids.tobytes())
        at += len(ids)


def brute_removal(texts, n=400):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for d, b in enumerate(raw):
        for i in range(len(b) - n + 1):
            seen.setdefault(b[i : i + n], []).append((d, i))
    gone = [bytearray(len(b)) for b in raw]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + n] = b"\x01" * n
    return [(len(b), sum(g), len(re.findall(b"\x01+", bytes(g))), hashlib.sha256(bytes(x for x, k in zip(b, g, strict=True) if not k)).hexdigest()) for b, g in zip(raw, gone, strict=True)]


def test_suffix_dedup_by_brute_force(spark):
    rng = random.Random(6)
    passage, other = words(rng, 120), words(rng, 70)
    texts = [None, "", "short", words(rng, 200), words(rng, 40) + passage + words(rng, 40), passage[:405] + words(rng, 90), words(rng, 60) + passage[3:402], words(rng, 60) + passage[3:403], other * 3, "ab" * 500, "x" * 900, words(rng, 30) + other + words(rng, 9), passage, passage, "é" * 250 + words(rng, 10)]
    for _ in range(25):  # pieces of the passage with changes, about the length of a match
        a = rng.randrange(0, max(1, len(passage) - 500))
        piece = list(passage[a : a + rng.randint(390, 520)])
        if rng.random() < 0.5:
            piece[rng.randrange(len(piece))] = "#"
        texts.append(words(rng, 20) + "".join(piece) + words(rng, 20))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.deduplicate(frame(spark, list(enumerate(texts)))).collect()}
    assert [got[i] for i in range(len(texts))] == brute_removal(texts)


def test_suffix_dedup_rests_on_the_sort(spark, monkeypatch):
    rng = random.Random(7)
    passage = words(rng, 300)
    docs = frame(spark, [(1, words(rng, 50) + passage + words(rng, 50)), (2, passage), (3, "ab" * 400 + words(rng, 80)), (4, words(rng, 60) + "ab" * 400), (5, "ñ" * 700), (6, passage), (6, passage)])
    want = [tuple(r) for r in suffixes.deduplicate(docs).drop("spans").orderBy("doc_id", "n_removed").collect()]
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    assert [w[1:] for w in want] == brute_removal(texts)
    adjacent = suffixes.adjacent
    monkeypatch.setattr(suffixes, "adjacent", lambda rows: (adjacent(rows)[0].withColumn("most", F.lit(0).cast("bigint")), adjacent(rows)[1]))
    assert [tuple(r) for r in suffixes.deduplicate(docs).drop("spans").orderBy("doc_id", "n_removed").collect()] != want


def test_names_rank_triples_over_partitions(spark):
    rng = random.Random(9)
    rows = [(k, j, *(rng.randint(0, 2) for _ in range(3))) for k in range(40) for j in range(20)]
    got = suffixes.named(spark.createDataFrame(rows, "key bigint, j int, a bigint, b bigint, c bigint").repartition(7), 0)[0].collect()
    held = {(r.key, r.j): r.name for r in got}
    assert len(held) == len(rows)
    order = sorted(rows, key=lambda r: r[2:])
    assert all((held[a[:2]] == held[b[:2]]) == (a[2:] == b[2:]) and held[a[:2]] <= held[b[:2]] for a, b in zip(order, order[1:]))


def test_adjacent_prefixes_are_the_longest(spark):
    rng = random.Random(10)
    rows = [(o, k, j, *(rng.randint(1, 2) for _ in range(4)), rng.randint(1, 2) if o else 0, 0) for k in range(30) for j in range(9) for o in [rng.randint(0, 2)]]
    table = spark.createDataFrame(rows, "o tinyint, key bigint, j int, c0 bigint, c1 bigint, c2 bigint, c3 bigint, c4 bigint, c5 bigint").repartition(5)
    got = {}
    for r in suffixes.adjacent(table)[0].collect():
        got[r.key, r.j] = max(got.get((r.key, r.j), 0), r.most)
    as_columns = {r[1:3]: np.array([[r[0], *r[3:]]], np.int64).T for r in rows}
    for k, v in as_columns.items():
        assert got.get(k, 0) == max(int(suffixes.shared(v, w)[0]) for i, w in as_columns.items() if i != k)


PROSE = "A long paragraph with many words, commas and stops. " * 4


def test_the_cut_changes_labels():
    page = f"<div><p>{PROSE}</p><div>See the table</div><p>{PROSE}</p></div>"
    blocks = maintext.blocks_of(page)
    assert maintext.preference(blocks[1], "See the table", False) < 0
    assert "See the table" in maintext.main_text(page).split("\n")
    alone = f"<div><nav>a</nav><div>See the table</div><nav>b</nav></div><p>{PROSE}</p>"
    assert maintext.main_text(alone) == PROSE.strip()


def test_html_wrappers_comments_and_drawings():
    assert maintext.main_text('<div id="page" class="site sidebar-right"><main><p>A real article, with words.</p></main></div>') == "A real article, with words."
    assert maintext.main_text('<main><p>Text of it, long enough.</p></main><article class="comment"><p>Great, thanks for it.</p></article>') == "Text of it, long enough."
    assert maintext.main_text('<main><p>Text of it, long enough.</p></main><div id="comments"><article><p>Great, thanks for it.</p></article></div>') == "Text of it, long enough."
    assert maintext.main_text("<p>one <svg width=1/> two, three.</p><p>four</p>") == "one two, three.\nfour"
    assert maintext.main_text("<p>One, two.</p><svg><text>no</text></svg><p>Three, four.</p>") == "One, two.\nThree, four."
    assert maintext.main_text("<p>One <b a='>' c=\"d>\">two</b x> <!-- no --> three.<p") == "One two three."


def test_html_of_many_blocks_and_deep_nesting():
    page = "<div>" + "".join(f"<p>paragraph {k}, of some words.</p><div><a href=x>link {k}</a></div>" for k in range(10000)) + "</div>"
    began = time.perf_counter()
    assert maintext.main_text(page).count("\n") == 9999
    assert maintext.main_text("<b>" * 20000 + "<p>deep, and down.</p>") == "deep, and down."
    assert time.perf_counter() - began < 20


def test_maximum_flow_on_long_weak_chains():
    rng = random.Random(3)
    for _ in range(30):
        n = rng.randint(2, 9)
        gain = [rng.choice((-2.0, -1.0, 1.0, 2.0)) for _ in range(n)]
        edges = [(k, k + 1, 3.0) for k in range(n - 1)] + [(0, n - 1, 1.0)] * (n > 2)
        kept = maintext.minimum_cut([max(g, 0) for g in gain], [max(-g, 0) for g in gain], edges)
        cost = lambda side, gain=gain, edges=edges: sum(max(-g, 0) if s else max(g, 0) for g, s in zip(gain, side, strict=True)) + sum(c for a, b, c in edges if side[a] != side[b])
        assert cost(kept) == min(cost([bool(m >> k & 1) for k in range(n)]) for m in range(1 << n))


def test_html_of_an_empty_table(spark):
    assert maintext.extract(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0

import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from layerloom.llm import shingle_join
from layerloom.llm.components import components
from layerloom.llm.registry import op6_shingle_join
from tests.llm.conftest import texts_of

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text, words=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())


def brute(texts, words=4, percent=85):
    """(id, tokens, component) by comparing every pair."""
    sets = [(d, tokens(t, words)) for d, t in texts]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(s), least[find(i)]) for i, (d, s) in enumerate(sets))


def got(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def family(draw, n, words, edits, vocabulary):
    """A base text and ``n`` copies of it with a few words replaced."""
    base = draw.choices(vocabulary, k=words)
    out = [base]
    for _ in range(n):
        copy = list(base)
        for _ in range(draw.randint(0, edits)):
            copy[draw.randrange(words)] = draw.choice(vocabulary)
        out.append(copy)
    return [" ".join(x) for x in out]


def test_families(spark, monkeypatch):
    """Groups from two to many copies, some of them in reach of each other only through others,
    common passages, and blocks smaller than a group."""
    monkeypatch.setattr(shingle_join, "BLOCK", 16)
    draw = random.Random(7)
    vocabulary = [f"v{k}" for k in range(3000)]
    passage = " ".join(draw.choices(vocabulary, k=60))
    texts = []
    for n, words, edits in ((90, 200, 9), (60, 60, 2), (40, 20, 1), (3, 400, 10), (1, 90, 2), (12, 8, 1), (30, 5, 1)):
        texts += family(draw, n, words, edits, vocabulary)
    texts += [" ".join(draw.choices(vocabulary, k=80)) + " " + passage for _ in range(60)]
    texts += [passage + " x" * k for k in range(15)] + ["a b c"] * 5 + ["A b C"] + texts[:20]
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(shingle_join.join(df)) == brute(rows)


def test_star_of_copies(spark, monkeypatch):
    """Every copy links with the base alone: only the base, which is not the smallest, joins them."""
    monkeypatch.setattr(shingle_join, "BLOCK", 8)
    base = [f"b{k}" for k in range(300)]
    rows = []
    for c in range(40):
        copy = list(base)
        for k in range(14):
            copy[c * 7 + k] = f"c{c}k{k}"
        rows.append((c, " ".join(copy)))
    rows.append((1000, " ".join(base)))
    assert len({c for *_, c in brute(rows)}) < 41
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(shingle_join.join(df)) == brute(rows)


def test_whole_table(spark, documents):
    assert got(op6_shingle_join(spark, SF)) == brute(texts_of(documents))


def test_odd_and_empty(odd, none):
    found = shingle_join.join(odd).collect()
    assert len(found) == odd.count()
    named = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is not None)
    assert named == brute([(d, t) for d, t in texts_of(odd) if d is not None])
    assert [(r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is None] == [(1, None)]
    assert shingle_join.join(none).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 120), st.integers(0, 9), st.integers(0, 10_000))
def test_linked_sets_share_a_signature(n, swaps, seed):
    """Whatever is frequent: two linked sets have a common signature and pass the bitmaps."""
    draw = np.random.default_rng(seed)
    every = draw.integers(0, 1 << 63, 200, dtype=np.int64).astype(np.uint64)
    a = every[:n]
    b = np.concatenate([a[min(swaps, n) :], every[150 : 150 + draw.integers(0, 9)]])
    frequent = draw.permutation(every)[: draw.integers(0, 200)]
    marks, at = np.unique(frequent >> np.uint64(22), return_index=True)
    counts = draw.integers(11, 50, 200)[at]
    x, y = np.unique(a), np.unique(b)
    common = len(np.intersect1d(x, y))
    if not len(y) or 100 * common < 85 * (len(x) + len(y) - common):
        return
    sigs = [set(shingle_join.signatures(s, marks, counts, 22).tolist()) for s in (x, y)]
    assert sigs[0] & sigs[1]
    assert shingle_join.may_link(len(x), shingle_join.bitmap(x), len(y), shingle_join.bitmap(y))


def test_frequent_tokens_beyond_the_table(spark, monkeypatch):
    """Passages of more tokens than the table holds chain no unrelated documents: there is no long list."""
    monkeypatch.setattr(shingle_join, "FREQUENT", 4)
    found = []
    lists = shingle_join._lists

    def spied(signed):
        pairs, long = lists(signed)
        found.append(long.count())
        return pairs, long

    monkeypatch.setattr(shingle_join, "_lists", spied)
    draw = random.Random(3)
    passages = [" ".join(f"p{p}x{k}" for k in range(7)) for p in range(30)]
    rows = []
    for d in range(300):
        own = [f"d{d}x{k}" for k in range(50)]
        rows.append((d, " ".join(own[:25] + draw.sample(passages, 2) + own[25:])))
    rows += [(1000 + d, f"{t} end") for d, t in rows[::10]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(shingle_join.join(df)) == brute(rows)
    assert found == [0]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 120), st.integers(0, 9), st.integers(2, 12), st.integers(0, 10_000))
def test_linked_sets_share_a_signature_under_levels(n, swaps, bits, seed):
    """Whatever the map of levels holds besides the table, also where rare tokens hit it."""
    draw = np.random.default_rng(seed)
    every = draw.integers(0, 1 << 63, 200, dtype=np.int64).astype(np.uint64) * np.uint64(2)
    a, b = every[:n], np.concatenate([every[min(swaps, n) : n], every[150 : 150 + draw.integers(0, 9)]])
    frequent = draw.permutation(every)[: draw.integers(0, 60)]
    marks, at = np.unique(frequent >> np.uint64(22), return_index=True)
    levels = (draw.integers(0, 256, 1 << bits) * (draw.random(1 << bits) < draw.random())).astype(np.uint8)
    x, y = np.unique(a), np.unique(b)
    common = len(np.intersect1d(x, y))
    if not len(y) or 100 * common < 85 * (len(x) + len(y) - common):
        return
    counts = draw.integers(11, 50, 200)[at]
    sigs = [set(shingle_join.signatures(s, marks, counts, 22, levels=levels).tolist()) for s in (x, y)]
    assert sigs[0] & sigs[1]


def test_level_map(spark, monkeypatch):
    """Every token beyond the table has its level at its place, or a higher one of another."""
    monkeypatch.setattr(shingle_join, "SLICE_BITS", 5)
    draw = np.random.default_rng(1)
    marks = np.unique(draw.integers(0, 1 << 40, 500))
    level = draw.integers(55, 400, len(marks)).tolist()
    df = spark.createDataFrame(list(zip(marks.tolist(), level)), "mark long, level int")
    levels = shingle_join._level_map(df, len(marks), 40)
    want = np.zeros(1 << 12, np.int64)
    np.maximum.at(want, marks >> 28, np.minimum(level, 255))
    assert levels.tolist() == want.tolist()
    assert len(shingle_join._level_map(df.limit(0), 0, 40)) == 0


def test_shingle_counts():
    texts = [None, "", "a", "A b\tC", "a b c d", "a b c d a b c d", "é É e E e", " a \x0b b\x0cc\r\nd e "]
    assert [len(s) for s in shingle_join.shingles(pa.array(texts, pa.string()))] == [len(tokens(t)) for t in texts]


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 200), (200, 300), (150, 300), (7, 7)] + [(500, k) for k in range(501, 560)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = {**{k: 0 for k in range(41)}, **{k: 100 for k in (100, 150, 200, 300)}, **{k: 500 for k in range(500, 560)}}
    assert {r["node"]: r["component"] for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerloom.llm import collocations, registry

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, support=30, top=2000):
    """``rows`` are (text, lang)."""
    total, counts = Counter(), {}
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        total[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        kept = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < support:
                continue
            score, _, l, r = min(
                (2_000_000 * a // (f[phrase[:k]] + f[phrase[k:]]), k, f[phrase[:k]], f[phrase[k:]])
                for k in range(1, len(phrase))
            )
            kept.append((phrase, a, l, r, score))
        candidates = {p: a for p, a, *_ in kept}
        gone = set()
        for long, around in candidates.items():
            for size in range(2, len(long)):
                for i in range(len(long) - size + 1):
                    part = long[i : i + size]
                    if part in candidates and 100 * around >= 80 * candidates[part]:
                        gone.add(part)
        left = [(" ".join(p), a, l, r, s) for p, a, l, r, s in kept if p not in gone]
        left.sort(key=lambda x: (-x[4], -x[1], x[0].encode()))
        out += [(lang, rank, p, a, l, r, total[lang], s) for rank, (p, a, l, r, s) in enumerate(left[:top], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(3)
    words = ["The", "of", "new", "york", "city", "hall", "É", "x\x01y", "a-b", "in"]
    made = []
    for k in range(400):
        text = " ".join(words[w] for w in draw.zipf(1.3, 40) % len(words))
        text = text.replace("york", "york city hall,", 1) + (". New york city\thall" if k % 3 else "\nof of of of")
        made.append((text, [None, "en", "de", "und", ""][k % 5]))
    made += [(None, "en"), ("", "fr"), (" ... ", None)] + [made[7]] * 50
    return made


@pytest.mark.parametrize("support,top", [(30, 2000), (5, 7), (1, 2000)])
def test_against_brute_force(spark, rows, support, top):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    for clash in ("n", "phrase", "word", "key", "a", "score"):
        df = df.withColumn(clash, F.lit("clash"))
    got = collocations.collocations(df, support=support, top=top)
    want = brute(rows, support, top)
    assert found(got) == want and want


def test_small_chunks_and_full_bitmaps_change_nothing(spark, rows, monkeypatch):
    """What lets everything through, or counts little at a time, costs work only."""
    df = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    monkeypatch.setattr(collocations, "_bitmap", lambda value: np.full(len(value), 255, np.uint8))
    assert found(collocations.collocations(df, support=8)) == brute(rows, 8)


def test_odd_rows(spark, odd, none):
    pairs = [(r["text"], r["lang"]) for r in odd.collect()]
    assert found(collocations.collocations(odd, support=2)) == brute(pairs, 2)
    assert found(collocations.collocations(none)) == []


def test_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000
    df = spark.createDataFrame([(big, big + 1, big + 5)], "a long, l long, r long")
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div cast(l + r as decimal(20,0))")
    assert df.select(score).first()[0] == 2_000_000 * big // (2 * big + 6)


def test_local_supports_add_up(spark, rows):
    """A phrase that is rarer than its part of the support in every shard is rarer than the support."""
    for sizes in ([3, 4, 5, 6, 7], [1, 1, 1, 1, 100], [0, 0, 0, 0, 9]):
        whole = sum(sizes)
        needs = [max(1, -(-30 * s // whole)) for s in sizes]
        assert sum(n - 1 for n in needs) < 30


def test_query(spark):
    got = registry.op13_collocations(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert found(got) == brute([(r["text"], r["lang"]) for r in docs])

import math
import random
from collections import Counter

import numpy as np
from layerloom.llm import toxicity
from layerloom.llm.registry import op9_toxicity
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


def corpus(spark, n=600):
    draw = random.Random(3)
    words = ["".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    docs, labels = [], []
    for k in range(n):
        bad = k % 6 == 0
        text = draw.choices(words, k=40)
        if bad:
            text += ["zorkle" + draw.choice(["n", "st", "ing", "s"]) for _ in range(3)]
        draw.shuffle(text)
        docs.append((k, " ".join(text)))
        labels.append((k, int(bad)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_learns_an_unknown_stem(spark):
    docs, labels = corpus(spark)
    held_out = toxicity.held_out(4, 2)
    scored = toxicity.detect(docs, labels, ~held_out).where(held_out).join(labels, "doc_id").collect()
    hits = [(r["score"] >= toxicity.THRESHOLD) == bool(r["toxic"]) for r in scored]
    assert len(hits) > 100 and np.mean(hits) > 0.97


def brute_mine(rows):
    """Terms with their toxic shares, by counting every word and beginning of every text."""
    n, n_toxic = Counter(), Counter()
    for text, toxic in rows:
        words = [w for w in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()]
        terms = set(words)
        for k in toxicity.STEMS:
            begun = Counter(w[:k] for w in words if len(w) >= k)
            terms |= {s + "*" * m for s, c in begun.items() for m in toxicity.TIMES if c >= m}
        n.update(terms)
        n_toxic.update(terms if toxic else ())
    total = sum(t for _, t in rows)
    base, out = total / len(rows), {}
    for term, count in n.items():
        share = n_toxic[term] / count
        if share <= base or share < toxicity.MIN_SHARE or n_toxic[term] < toxicity.SUPPORT * total:
            continue
        rest = (1 - share) * math.log((1 - share) / (1 - base)) if share < 1 else 0.0
        if count * (share * math.log(share / base) + rest) >= toxicity.EVIDENCE:
            out[term] = share
    return out


def test_mining_by_brute_force(spark):
    docs, labels = corpus(spark)
    given = docs.join(labels, "doc_id").select("text", "toxic")
    want = brute_mine([tuple(r) for r in given.collect()])
    got = dict(toxicity.mine(given))
    assert set(got) == set(want) and "zork*" in want and len(want) > 8
    assert all(abs(got[t] - want[t]) < 1e-12 for t in want)


def test_what_is_mined_does_not_depend_on_the_number_of_rows(spark):
    docs, labels = corpus(spark)
    given = docs.join(labels, "doc_id").select("text", "toxic")
    once = set(dict(toxicity.mine(given)))
    four = set(dict(toxicity.mine(given.unionAll(given).unionAll(given).unionAll(given))))
    assert once <= four
    assert all(t.startswith("zork") for t in once) and once


def test_voters_can_outvote_a_label():
    """The posterior, not the label, is what the classifier is trained on."""
    patterns = np.array([0, 0b111])
    model = toxicity.LabelModel().fit(patterns, np.array([500.0, 100.0]), np.array([300.0, 2.0]), np.array([2.0, 60.0]))
    model.rate = np.clip(model.rate, 0.01, 0.99)
    model.weight = np.ones(toxicity.VOTERS)
    kept = model.posterior(np.array([0b111, 0]), np.array([0, 1]))
    assert kept[0] > 0.5 > kept[1]


def test_every_voter_is_a_feature():
    votes = np.array([1 << 3, 0] * 200)
    weights = toxicity.fit_linear([np.zeros(0, np.int64)] * 400, votes, (votes > 0).astype(float), 0)
    assert len(weights) == toxicity.VOTERS + 1 and weights[3] > 2 and abs(weights[5]) < 1e-9


def test_held_out_quality(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in op9_toxicity(spark, SF).collect() if r["held_out"] and r["doc_id"] in labels]
    hit = sum(r["predicted"] and labels[r["doc_id"]] for r in rows)
    assert hit / sum(r["predicted"] for r in rows) > 0.9
    assert hit / sum(labels[r["doc_id"]] for r in rows) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_label_model_shares_weight_among_copies():
    """Ten voters that always say the same count about as one; accurate ones move the posterior."""
    draw = np.random.default_rng(0)
    truth = draw.random(20_000) < 0.2
    votes = np.zeros(len(truth), np.int64)
    same = draw.random(len(truth)) < np.where(truth, 0.6, 0.3)
    for k in range(10):
        votes |= same.astype(np.int64) << k
    for k in range(10, 14):
        votes |= (draw.random(len(truth)) < np.where(truth, 0.7, 0.05)).astype(np.int64) << k
    patterns, at = np.unique(votes, return_inverse=True)
    known = draw.random(len(truth)) < 0.3
    count = lambda m: np.bincount(at[m], minlength=len(patterns)).astype(float)
    model = toxicity.LabelModel().fit(patterns, count(~known), count(known & ~truth), count(known & truth))
    assert model.weight[:10].max() < 0.15 and model.weight[10:14].min() > 0.5
    right = (model.posterior(patterns)[at] > 0.5) == truth
    assert right.mean() > 0.95


def test_odd_and_empty(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    scored = toxicity.detect(odd, labels, F.lit(True)).collect()
    assert len(scored) == odd.count() and all(0 <= r["score"] <= 1 for r in scored)
    no_labels = toxicity.detect(odd, labels.limit(0), F.lit(True)).collect()
    assert max(r["score"] for r in no_labels) < 1e-9
    assert toxicity.detect(none, labels, F.lit(True)).count() == 0

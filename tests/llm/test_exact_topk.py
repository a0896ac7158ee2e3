import numpy as np
import pytest
from layerloom.llm import exact_topk
from layerloom.llm.registry import op10_exact_topk
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def held(score):
    return min(max(score, 1 - 2**63), 2**63 - 1)


def brute(rows, ask, k=5):
    """(query, rank, vec, score) over (id, vector) rows; equal ids ask with the smallest vector."""
    real = [
        (i, [int(np.floor(256 * float(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for q in sorted({i for i, _ in real if i is not None and ask(i)}):
        mine = min(v for i, v in real if i == q)
        scores = sorted((-held(sum(a * b for a, b in zip(mine, v))), i) for i, v in real if i is not None and i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


def got(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert got(op10_exact_topk(spark, SF)) == brute(rows, lambda i: i % 50 == 0)


@pytest.mark.parametrize("k", [1, 4])
def test_ties_copies_and_lengths(spark, monkeypatch, k):
    """Many equal vectors, blocks smaller than their number, vectors of several lengths and scales."""
    monkeypatch.setattr(exact_topk, "BLOCK", 7)
    monkeypatch.setattr(exact_topk, "QUERIES", 3)
    monkeypatch.setattr(exact_topk, "CHUNK", 2)
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=6).tolist()) for i in range(60)]
    rows += [(100 + i, [0.5, 0.5, 0.0, 0.0, 0.0, 0.0]) for i in range(40)]
    rows += [(200 + i, (5 * draw.normal(size=3)).tolist()) for i in range(9)] + [(300, []), (301, [0.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [tuple(r) for r in df.collect()]
    assert got(exact_topk.search(df, F.col("vec_id") % 10 == 0, k, n_pivots=5)) == brute(rows, lambda i: i % 10 == 0, k)


def test_odd_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [1.0, 1.0]), (6, [0.5, -1.0])]
    rows += [(0, [1.0, 0.0]), (5, [1.0, 1.0]), (0, [0.9, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr(
        "*", "'x' AS score", "'x' AS pivot", "'x' AS v", "'x' AS query_id"
    )
    assert got(exact_topk.search(df, F.col("vec_id") % 5 == 0)) == brute(rows, lambda i: i % 5 == 0)
    assert got(exact_topk.search(df.limit(0), F.col("vec_id") % 5 == 0)) == []
    assert got(exact_topk.search(df.where("vec_id = 0"), F.col("vec_id") == 0)) == []


def test_null_ids_take_no_part(spark):
    rows = [(None, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (None, [9.0, 9.0]), (2, [0.5, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(exact_topk.search(df, F.col("vec_id") % 2 == 0)) == brute(rows, lambda i: i % 2 == 0)
    nothing = df.where("vec_id is null")
    assert got(exact_topk.search(nothing, F.col("vec_id") % 2 == 0)) == []


@pytest.mark.parametrize("scale", [1e6, 3e7, 1e10, 1e15])
def test_integers_beyond_floats(spark, scale):
    """Scores that differ in their last digits only, also where no float holds them."""
    draw = np.random.default_rng(5)
    base = draw.normal(size=8) * scale
    rows = [(i, (base + draw.integers(-3, 4, 8) / 256).tolist()) for i in range(80)]
    rows += [(100 + i, (-base + draw.integers(-3, 4, 8) / 256).tolist()) for i in range(20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(exact_topk.search(df, F.col("vec_id") % 10 == 0)) == brute(rows, lambda i: i % 10 == 0)


def test_mixed_scales_keep_the_directory_small(spark, monkeypatch):
    draw = np.random.default_rng(6)
    rows = [(i, (draw.normal(size=5) * 10.0 ** draw.integers(-2, 5)).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    seen, made = [], exact_topk._Directory.__init__

    def counted(self, found, pivots):
        seen.append(len(found))
        made(self, found, pivots)

    monkeypatch.setattr(exact_topk._Directory, "__init__", counted)
    assert got(exact_topk.search(df, F.col("vec_id") % 9 == 0, n_pivots=4, rings=10)) == brute(rows, lambda i: i % 9 == 0)
    assert seen and max(seen) <= 40

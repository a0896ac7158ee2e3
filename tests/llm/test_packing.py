import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from layerloom.llm import packing
from layerloom.llm.registry import BYTE_BPE, op5_best_fit_packing
from tests.llm.conftest import SF, texts_of
from tokenizers import Tokenizer


def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 24), st.integers(1, 40)))
def test_plan_is_best_fit(histogram):
    rows = packing.plan(histogram, 24)
    bins = {}
    for length, low, high, first, offset in rows:
        for k in range(high - low):
            bins.setdefault(first + k, []).append((offset, length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 24
    for length, n in histogram.items():
        ranks = sorted(r for l, low, high, *_ in rows if l == length for r in range(low, high))
        assert ranks == list(range(n))
    assert len(bins) == best_fit([l for l, n in histogram.items() for _ in range(n)], 24)


def test_plan_does_not_grow_with_the_data():
    draw = random.Random(1)
    histogram = {n: draw.randint(1, 50) for n in range(1, 2049)}
    small = len(packing.plan(histogram))
    assert len(packing.plan({n: c * 1_000_000 for n, c in histogram.items()})) < 4 * small


def check(rows, texts):
    code = Tokenizer.from_file(BYTE_BPE)
    want = {}
    for doc, text in texts:
        want.setdefault(doc, []).append(np.array(code.encode(text, add_special_tokens=False).ids + [0], "<u4"))
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append(r)
    assert set(got) == set(want)
    for doc, found in got.items():
        pieces = []
        for ids in want[doc]:
            edges = list(range(len(ids) % 2048 or 2048, len(ids) + 1, 2048))
            pieces += [(k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip([0, *edges], edges))]
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == sorted(pieces)
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(bins) == best_fit([r["length"] for r in rows], 2048)


def test_whole_table(spark, documents):
    check(op5_best_fit_packing(spark, SF).collect(), texts_of(documents))


def test_odd_and_empty(odd, none):
    check(packing.pack(odd, BYTE_BPE).collect(), texts_of(odd))
    assert packing.pack(none, BYTE_BPE).count() == 0


def test_copies_of_a_row_are_spread_and_packed_each(spark):
    rows = [(7, "the same text")] * 3000 + [(None, "no id")] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    packed = packing.pack(docs, BYTE_BPE)
    check_places = {(r["sequence_id"], r["offset"]) for r in packed.collect()}
    assert len(check_places) == len(rows)
    plan = packed._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(lane" in plan and "xxhash64(doc_id" not in plan

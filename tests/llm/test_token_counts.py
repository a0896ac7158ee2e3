import numpy as np
import pytest
from layerloom.llm import token_counts
from layerloom.llm.registry import BYTE_BPE
from tests.llm.conftest import ODD_TEXTS, texts_of
from tokenizers import Tokenizer


def brute(text, rule, code):
    lines, at = [], 0
    for line in text.split("\n"):
        end = min(len(text), at + len(line) + 1)
        lines.append((at, end))
        at = end
    lines = [x for x in lines if x[1] > x[0]]
    counts = [[0, 0] for _ in lines]
    for a, b in code.encode(text, add_special_tokens=False).offsets:
        touched = [k for k, (s, e) in enumerate(lines) if a < e and max(b, a + 1) > s]
        if rule == "start":
            k = touched[0]
        elif rule == "end":
            k = touched[-1]
        else:
            k = max(touched, key=lambda k: (min(b, lines[k][1]) - max(a, lines[k][0]), -k))
        counts[k][0] += 1
        counts[k][1] += len(touched) > 1
    return [(k, s, e - s, *c) for k, ((s, e), c) in enumerate(zip(lines, counts))]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_against_brute_force(spark, rule):
    texts = [t for t in ODD_TEXTS if t and len(t) < 100] + ["a\n\n\n\nb", "\n\n", "x \n y\n", "é\n漢\n\n🙂", "one\ntwo\n"]
    code = Tokenizer.from_file(BYTE_BPE)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in token_counts.count_lines(df, BYTE_BPE, rule).orderBy("doc_id", "section").collect():
        got.setdefault(r["doc_id"], []).append(tuple(r)[1:])
    assert got == {k: brute(t, rule, code) for k, t in enumerate(texts)}


def test_allocation_of_crossing_tokens():
    starts = np.array([0, 4, 5])
    spans = np.array([[0, 4], [3, 6], [2, 5], [3, 5]])
    assert token_counts.allocate(spans, starts, "start")[0].tolist() == [0, 0, 0, 0]
    assert token_counts.allocate(spans, starts, "end")[0].tolist() == [0, 2, 1, 1]
    owner, crossing = token_counts.allocate(spans, starts, "overlap")
    assert owner.tolist() == [0, 0, 0, 0] and crossing.tolist() == [False, True, True, True]


def test_fields(spark):
    df = spark.createDataFrame([(1, "two words", None), (2, None, "b")], "doc_id long, title string, body string")
    got = token_counts.count_fields(df, ["title", "body"], BYTE_BPE).orderBy("doc_id", "section").collect()
    assert [(r["doc_id"], r["section"], r["n_chars"]) for r in got] == [(1, 0, 10), (1, 1, 0), (2, 0, 1), (2, 1, 1)]
    code = Tokenizer.from_file(BYTE_BPE)
    assert sum(r["n_tokens"] for r in got) == sum(len(code.encode(t).ids) for t in ("two words\n", "\nb"))


def test_totals_are_kept(documents):
    code = Tokenizer.from_file(BYTE_BPE)
    total = sum(len(code.encode(t, add_special_tokens=False).ids) for _, t in texts_of(documents))
    assert token_counts.count_lines(documents, BYTE_BPE).agg({"n_tokens": "sum"}).first()[0] == total


def test_odd_and_empty(odd, none):
    found = token_counts.count_lines(odd, BYTE_BPE)
    assert found.where("doc_id = 4").count() == 3
    assert found.where("doc_id IN (0, 1)").count() == 0
    assert token_counts.count_lines(none, BYTE_BPE).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_lines(odd, BYTE_BPE, "any")

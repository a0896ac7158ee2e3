import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from layerloom.llm import registry, winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def cut(text):
    return WORD.findall((text or "").translate(FOLD))


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        words = cut(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    rows = []
    for doc, text in docs:
        words, hit, met = cut(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    met |= found
        names = sorted((str(x) for x in met if x is not None), key=lambda s: s.encode())
        rows.append((doc, len(words), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(rows, key=repr)


COLUMNS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def found(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id long, text string, name string, start int")


@pytest.fixture(scope="module")
def planted():
    """Random words of a small vocabulary, with spans of items of every length put into texts."""
    draw = random.Random(7)
    word = lambda: draw.choice("ab bc Cd dE é 12 zz yy x9 qq".split())
    items = [(k, " ".join(word() for _ in range(size))) for k, size in enumerate((1, 3, 5, 6, 8, 9, 10, 11, 14, 30, 60))]
    items = [(k, t) for k, t in items if len(t.split()) >= 3]
    items += [(20, None), (21, ""), (22, "... !"), (23, items[-1][1]), (23, items[3][1]), (None, items[2][1]), (100, items[-1][1])]
    docs = []
    for k in range(60):
        body = [word() for _ in range(draw.randrange(0, 80))]
        source = draw.choice([t for _, t in items if t and cut(t)]).split()
        a = draw.randrange(len(source))
        body[len(body) // 2 : len(body) // 2] = source[a : a + draw.randrange(1, 40)]
        docs.append((k % 50, draw.choice([" ", ", ", "\n"]).join(body)))
    docs += [(99, None), (98, ""), (None, items[-3][1] or ""), (97, " ".join(items[6][1].split() * 500))]
    return docs, items


def test_against_brute_force(spark, planted):
    docs, items = planted
    df = spark.createDataFrame(docs + docs[:5], "doc_id long, text string")
    for clash in ("n_hit", "items", "name", "start", "length"):
        df = df.withColumn(clash, F.lit("clash"))
    want = brute(docs + docs[:5], items)
    assert found(winnowing.digests(df, items_of(spark, items))) == want
    assert any(r[2] for r in want) and any(not r[2] for r in want)


def test_odd_rows(spark, odd):
    items = [(1, "one two three"), (2, " ".join(f"w{k}" for k in range(500, 530))), (3, "漢字 €uro")]
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(winnowing.digests(odd, items_of(spark, items))) == brute(rows, items)


def test_every_span_of_a_window_is_found(spark):
    """Whatever stands around it and wherever it begins, a shared span of ten words has a common fingerprint."""
    item = [f"t{k}" for k in range(25)]
    docs = [(k, " ".join([f"a{k}x{j}" for j in range(k)] + item[k : k + 10] + ["end"])) for k in range(16)]
    got = winnowing.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), items_of(spark, [(5, " ".join(item))]))
    assert {(r["doc_id"], r["n_hit"], tuple(r["items"])) for r in got.collect()} == {(k, 10, ("5",)) for k in range(16)}


def test_empty(spark, none, documents):
    items = items_of(spark, [(1, "a b c")])
    assert found(winnowing.digests(none, items)) == []
    got = found(winnowing.digests(documents, items_of(spark, [])))
    assert len(got) == documents.count() and not any(r[-1] for r in got)


def test_native(spark, documents):
    plan = winnowing.digests(documents, items_of(spark, [(1, "a b c")]))._jdf.queryExecution().toString()
    assert not re.search(r"Python|MapIn|FlatMap|Cartesian|NestedLoop", plan)


def test_query(spark):
    got = registry.op12_winnowing(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    assert found(got) == brute([(r["doc_id"], r["text"]) for r in docs], [(r["item_id"], r["text"]) for r in items])

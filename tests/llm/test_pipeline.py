import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from layerloom.llm import registry, toxicity
from layerloom.llm.common import stage
from tests.llm.conftest import SF, texts_of
from tests.llm.test_packing import check
from tests.llm.test_shingle_join import brute


def test_stages_agree_with_their_operators(spark, documents):
    """Each stage keeps exactly the rows its operator's result says, in the columns of the table."""
    assert [n for n, _ in cp.STAGES] == ["language_ranks", "toxicity", "shingle_join", "best_fit_packing"]
    docs, names = documents, documents.columns
    for name, step in cp.STAGES[:-1]:
        before = docs
        docs = stage(step(spark, docs, SF))
        assert docs.columns == names
        kept = {r["doc_id"] for r in docs.collect()}
        if name == "shingle_join":
            rows = brute(texts_of(before), 5, 80)
            assert kept == {d for d, _, c in rows if d == c}
        elif name == "toxicity":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            scored = toxicity.detect(before, labels, ~toxicity.held_out(*registry.TOXICITY_FOLDS)).collect()
            assert kept == {r["doc_id"] for r in scored if r["score"] < toxicity.THRESHOLD}
    check(cp.STAGES[-1][1](spark, docs, SF).collect(), texts_of(docs))
    assert cp.run(spark, SF).select("doc_id").distinct().count() == docs.count()


def test_language_stage_drops_what_has_no_letter(spark, documents):
    rows = [(10_000 + k, t, None, None, None) for k, t in enumerate([None, "", "123 $$$", "!!!"])]
    extra = spark.createDataFrame(rows, documents.schema)
    kept = cp.language(spark, documents.unionByName(extra), SF)
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in documents.collect()}


def test_odd_and_empty(spark, odd, none):
    for docs in (odd, none):
        for _, step in cp.STAGES[:-1]:
            found = stage(step(spark, docs, SF))
            assert found.columns == docs.columns and found.count() <= docs.count()
            docs = found
        assert cp.STAGES[-1][1](spark, docs, SF).count() >= docs.count()


def test_near_duplicates_link_at_five_words_and_80(spark, documents):
    """Copies with 1 to 14 words replaced, many of them between this threshold and op6's own."""
    draw = random.Random(11)
    vocabulary = [f"v{k}" for k in range(4000)]
    texts = ["a b c d", "a b c d", "A b c d e", "a b c d e f"]
    for words in (9, 40, 120, 120, 200, 300):
        base = draw.choices(vocabulary, k=words)
        texts.append(" ".join(base))
        for edits in range(1, 15):
            copy = list(base)
            for k in draw.sample(range(words), min(edits, words // 8)):
                copy[k] = draw.choice(vocabulary)
            texts.append(" ".join(copy))
    rows = [(k, t, None, None, None) for k, t in enumerate(texts)]

    def kept_by(words, percent):
        sets = [_shingles(t, words) for t in texts]
        group = list(range(len(texts)))
        for i, a in enumerate(sets):
            for j in range(i):
                if 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                    low, high = sorted((group[i], group[j]))
                    group = [low if g == high else g for g in group]
        return {k for k, g in enumerate(group) if k == g}

    assert kept_by(5, 80) != kept_by(4, 85)
    kept = cp.near_duplicates(spark, spark.createDataFrame(rows, documents.schema), SF)
    assert {r["doc_id"] for r in kept.collect()} == kept_by(5, 80)


def _shingles(text, words):
    w = text.lower().split()
    return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or {tuple(w)}


def test_different_texts_of_one_id_stay(spark, documents):
    """Only equal rows of an id are one; a different text that shares the id is not dropped."""
    one, two = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    rows = [(7, one, "en", "s", 1), (7, one, "en", "s", 1), (7, two, "en", "s", 1), (8, one + " z", "en", "s", 1)]
    kept = cp.near_duplicates(spark, spark.createDataFrame(rows, documents.schema), SF)
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(7, one), (7, two)]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _texts_moved(df):
    """Rows with a text that shuffles of the finished query wrote."""
    found, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            nodes.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec" and " text#" in f" {node.output().mkString(' ')}":
                found += node.metrics().apply("shuffleRecordsWritten").value()
            children = node.children()
            nodes += [children.apply(k) for k in range(children.size())]
    return found


def test_texts_that_stay_are_not_moved(spark, documents, no_broadcast):
    """However many keys are rejected, only their rows meet them in a join."""
    rows = [(k, f"text {k}", "en", "s", 1) for k in range(4000)]
    rows += [(None, "gone", None, None, None), (None, "stays", None, None, None), (7, None, None, "s", None)]
    rows += [(11, "text 10", None, "s", 1), (12, "stays", None, "s", 1), (20, "text 20", "en", "s", 1)]
    docs = stage(spark.createDataFrame(rows, documents.schema))
    bad = (F.col("doc_id") % 10 == 0) | (F.col("text") == "gone") | F.col("text").isNull()
    kept = cp._without(docs, cp._keyed(docs).where(F.coalesce(bad, F.lit(False))))
    assert kept.columns == docs.columns
    gone = lambda r: r[1] in (None, "gone") or (r[0] is not None and r[0] % 10 == 0)
    plain = lambda found: sorted((tuple(r) for r in found), key=repr)
    assert plain(kept.collect()) == plain(r for r in rows if not gone(r))
    assert 403 <= _texts_moved(kept) < 450


def test_a_full_map_of_rejected_keys_loses_nothing(spark, documents, no_broadcast, monkeypatch):
    monkeypatch.setattr(cp, "MAP_BITS", 1)
    docs = stage(spark.createDataFrame([(k, f"text {k}", "en", "s", 1) for k in range(4000)], documents.schema))
    kept = cp._without(docs, cp._keyed(docs).where("doc_id % 2 = 0"))
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(1, 4000, 2))
    assert _texts_moved(kept) == 4000


def test_near_duplicates_move_only_what_goes_or_repeats(spark, documents, no_broadcast, monkeypatch):
    """Texts that stay are not moved; rows of one id are told apart by their texts, null ids stay."""
    draw = random.Random(2)
    texts = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(30)) for _ in range(200)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(300 + k, texts[k]) for k in range(5)]
    rows += [(7, texts[7]), (8, texts[8] + " end"), (None, texts[0]), (None, None), (400, ""), (400, texts[9])]
    docs = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], documents.schema)
    moved, keyed = [], cp._keyed
    monkeypatch.setattr(cp, "_keyed", lambda df: moved.append(df.count()) or keyed(df))
    kept = sorted(((r["doc_id"], r["text"]) for r in cp.near_duplicates(spark, docs, SF).collect()), key=str)
    # 7 came twice; of 400, which has a text that goes with 9, an empty one stays by itself.
    want = set(rows) - {(300 + k, texts[k]) for k in range(5)}
    assert kept == sorted([*want], key=str)
    assert moved[0] < 20

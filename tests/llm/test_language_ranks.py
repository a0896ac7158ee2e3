from collections import Counter

from layerloom.llm import language_ranks
from layerloom.llm.registry import op4_language_ranks

SF = "/root/testdata/sf0.01"


def grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    out = Counter()
    for w in words:
        out.update(w)
    joined = "_" + "_".join(words) + "_" if words else ""
    out.update(joined[i : i + 2] for i in range(len(joined) - 1))
    out.update(joined[i : i + 3] for i in range(len(joined) - 2) if joined[i + 1] != "_")
    return out


def code(g):
    p = [0 if c == "_" else ord(c) for c in g]
    return p[0] if len(p) == 1 else -1 - (p[0] << 21 | p[1]) if len(p) == 2 else p[0] << 42 | p[1] << 21 | p[2]


def test_grams():
    for text in ("", None, "...", "Hello, World!", "a", "é 漢字 x1y"):
        want = Counter()
        for g, n in grams(text or "").items():
            want[code(g)] += n
        assert Counter(language_ranks.grams(text).tolist()) == want


def test_profiles_and_ranks(spark):
    rows = [("abab abab", "x"), ("cdcd", "y"), (None, "x"), ("zz", None), ("ab", "x")]
    profiles = language_ranks.learn(spark.createDataFrame(rows, "text string, lang string"), size=5)
    want = Counter()
    for t in ("abab abab", "ab"):
        want.update(grams(t))
    top = sorted(want, key=lambda g: (-want[g], code(g)))[:5]
    assert profiles["x"] == [code(g) for g in top] and set(profiles) == {"x", "y"}
    rank = language_ranks.Ranker(profiles, 5)
    assert rank("abab")[0] == "x" and rank("cdcd")[0] == "y"
    assert rank("123") == ("und", 0.0) and rank(None) == ("und", 0.0)
    assert rank("qq")[0] == "x"  # equally far from both: the smaller name


def out_of_place(text, profiles, size):
    """Language and score by the plain definition of the distance."""
    counts = Counter()
    for g, n in grams(text or "").items():
        counts[code(g)] += n
    top = sorted(counts, key=lambda c: (-counts[c], c))[:size]
    if not top:
        return "und", 0.0
    far = {}
    for lang, profile in profiles.items():
        place = {c: k for k, c in enumerate(profile)}
        far[lang] = sum(abs(place[c] - k) if c in place else size for k, c in enumerate(top))
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (size * len(top))


def test_distance_by_brute_force(spark, documents, odd):
    for size in (20, language_ranks.PROFILE):
        profiles = language_ranks.learn(documents, size=size)
        assert len(profiles) > 1
        for docs in (documents, odd):
            found = language_ranks.predict(docs, profiles, size=size, keep=("doc_id", "text")).collect()
            assert len(found) == docs.count()
            for r in found:
                lang, score = out_of_place(r["text"], profiles, size)
                assert r["lang_pred"] == lang and abs(r["score"] - score) < 1e-9


def test_held_out_accuracy(spark):
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in op4_language_ranks(spark, SF).collect() if r["held_out"]]
    assert len(rows) > 100
    assert sum(known[r["doc_id"]] == r["lang_pred"] for r in rows) / len(rows) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_and_empty(odd, none):
    profiles = language_ranks.learn(odd)
    assert list(profiles) == ["en"]
    found = language_ranks.predict(odd, profiles).collect()
    assert len(found) == odd.count()
    assert {r["lang_pred"] for r in found if r["doc_id"] in (0, 1, 2, 3)} == {"und"}
    assert language_ranks.learn(none) == {} and language_ranks.predict(none, {}).count() == 0
    assert {r["lang_pred"] for r in language_ranks.predict(odd, {}).collect()} == {"und"}

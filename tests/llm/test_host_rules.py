import re

from layerloom.llm import host_rules
from tests.llm.conftest import LONG


def measured(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    places = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    n = len(places)
    failed = len(words) < 50 or 100 * n > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), len("".join(words)), symbols, len(lines) - len(set(lines)), n, failed


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_measures(spark):
    texts = [
        None, "", "a a a a", "a b c a b c", "x\nx\n\n x\nx ", "# $a*\n|<>|", "é é é é é", "a b c d a b c", "p q\x0br\x0cs", "\x1c\x85 z",
        "the cat sat " * 30, " ".join(f"{k % 7} {k % 5}" for k in range(60)),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'s' AS source")
    got = {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in host_rules.measure(df).collect()}
    assert got == {k: measured(t) for k, t in enumerate(texts)}


def test_long_text(spark):
    df = spark.createDataFrame([(1, LONG, None), (2, "a b " * 20_000, None)], "doc_id long, text string, source string")
    got = {r["doc_id"]: (r["n_words"], r["n_repeat_words"]) for r in host_rules.measure(df).collect()}
    assert got == {1: (20_000, 0), 2: (40_000, 40_000)}


def test_host_verdicts(spark):
    good = " ".join(f"w{k}" for k in range(60))
    rows = [(k, good if k % 10 else "short", "fine") for k in range(40)]
    rows += [(100 + k, "short" if k % 10 else good, "bad") for k in range(40)]
    rows += [(200, good, "single"), (201, "short", "small"), (202, good, "small"), (300, good, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"]: r["kept"] for r in host_rules.judge(df).collect()}
    assert not any(kept[100 + k] for k in range(40))  # also the good ones of the bad host
    assert all(kept[k] == (k % 10 > 0) for k in range(40))
    assert kept[200] and kept[202] and kept[300] and not kept[201]


def test_one_host_and_equal_hosts(spark):
    """No spread between hosts: the prior is as strong as it may be and moves nothing."""
    good = " ".join(f"w{k}" for k in range(60))
    rows = [(k, good, f"s{k % 2}") for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert all(r["kept"] for r in host_rules.judge(df).collect())
    assert not any(r["kept"] for r in host_rules.judge(df.selectExpr("doc_id", "'x' AS text", "source")).collect())


def test_odd_and_empty(odd, none):
    assert host_rules.judge(odd).count() == odd.count()
    assert host_rules.judge(none).count() == 0


def test_native(odd):
    plan = host_rules.measure(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_against_sql(spark):
    import duckdb
    from layerloom.llm import registry

    sf = "/root/testdata/sf0.01"
    got = sorted(map(tuple, registry.op2_host_rules(spark, sf).select("doc_id", *COLUMNS, "kept").collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    found = con.execute(registry.oracle_sql()["op2_host_rules"])
    assert [d[0] for d in found.description] == ["doc_id", *COLUMNS, "kept"]
    assert got == sorted(found.fetchall())

"""Quality rules with verdicts of hosts (native: DataFrame functions only).

Each document is measured by itself; failures are counted per host, the failure rate of a host is
shrunk towards the rate of all hosts by a beta prior that is fitted to the hosts, and hosts whose
shrunk rate is too high take all their documents with them.

Defined cases: a null or empty text has no words, so it fails; a null host has no verdict and its
documents are judged alone; repeated rows are measured and counted each; an empty table gives an
empty result. Columns other than the three named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerloom.llm.common import SPACE, stage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A host goes when more than this part of its documents fails, after shrinking.
MAX_HOST_RATE = 0.5
# Bounds of the prior's weight, in documents.
PRIOR_WEIGHT = (1.0, 1_000_000.0)
_SYMBOLS = r"[#*$%&|<>]"


def _windows(words: Column) -> Column:
    """A 64-bit hash of each 3-word window; null for fewer words."""
    n = F.size(words)
    window = lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(3)))
    return F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window))


def _covered(places: Column) -> Column:
    """Words under the windows that begin at these ascending places."""
    steps = F.transform(
        places,
        lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3))),
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda total, x: total + x)


def measure(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """One row per document: id, host, ``n_words``, ``word_chars``, ``n_symbols``,
    ``n_dup_lines``, ``n_repeat_words`` and ``base_failed``. No shuffle.

    Repeated windows are equal neighbours once the hashes are sorted with their places; words under
    several of them count once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    base = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(text_col).alias("text")
    )
    split = base.select(
        "doc_id",
        "host",
        F.array_remove(F.split(text, SPACE), "").alias("words"),
        F.filter(F.split(text, "\n"), has_word).alias("lines"),
        (F.length(text) - F.length(F.regexp_replace(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    counted = split.select(
        "doc_id",
        "host",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _windows(F.col("words")).alias("windows"),
    )
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = counted.withColumn(
        "ordered",
        F.when(repeated, F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    ).drop("windows")
    rows = F.col("ordered")

    def twin(pair, k):
        same = lambda other: F.coalesce(pair["h"] == other["h"], F.lit(False))
        return same(F.when(k > 0, F.get(rows, k - 1))) | same(F.get(rows, k + 1))

    marked = ordered.withColumn(
        "places", F.sort_array(F.transform(F.filter(rows, twin), lambda pair: pair["i"]))
    ).drop("ordered")
    repeat_words = F.coalesce(F.when(F.col("places").isNotNull(), _covered(F.col("places"))), F.lit(0))
    out = marked.withColumn("n_repeat_words", repeat_words.cast("long")).drop("places")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return out.withColumn("base_failed", failed)


def host_rates(measured: DataFrame) -> DataFrame:
    """Per host: ``n_docs``, ``n_failed`` and the shrunk ``rate``.

    The prior is the beta distribution whose mean and variance are those of the hosts' rates,
    weighted by their documents; its weight is held within ``PRIOR_WEIGHT``. Rows are combined
    before they move, so a host with a third of all documents is one row per task.
    """
    hosts = stage(
        measured.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n_docs"), F.count_if("base_failed").alias("n_failed"))
    )
    n, f = F.col("n_docs"), F.col("n_failed")
    totals = hosts.agg(
        (F.sum(f) / F.sum(n)).alias("mean"),
        (F.sum(f * f / n) / F.sum(n) - F.pow(F.sum(f) / F.sum(n), F.lit(2.0))).alias("var"),
    )
    low, high = map(F.lit, PRIOR_WEIGHT)
    mean, var = F.col("mean"), F.col("var")
    weight = F.when(var > 0, F.greatest(low, F.least(high, mean * (1 - mean) / var - 1))).otherwise(high)
    prior = totals.select(F.struct(mean.alias("mean"), weight.alias("weight")).alias("prior"))
    rated = hosts.withColumn("prior", prior.scalar())
    rate = (f + F.col("prior.mean") * F.col("prior.weight")) / (n + F.col("prior.weight"))
    return rated.select("host", "n_docs", "n_failed", rate.alias("rate"))


def judge(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """``measure`` with ``kept``: false for failed documents and for those of rejected hosts.

    The measures are written once, since the hosts' counts and the verdicts both read them. Only
    rejected hosts are joined back; Spark broadcasts them if they are few and splits a hot host
    otherwise.
    """
    measured = stage(measure(docs, id_col, text_col, host_col))
    rejected = host_rates(measured).where(F.col("rate") > MAX_HOST_RATE).select("host", F.lit(True).alias("gone"))
    return measured.join(rejected, "host", "left").select(
        "doc_id",
        "host",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.col("gone").isNull()).alias("kept"),
    )


def _sql() -> str:
    ws = r"[\x20\x09-\x0D]+"
    return f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS text FROM documents
), cut AS (
  SELECT *, list_filter(regexp_split_to_array(text, '{ws}'), lambda x : x <> '') AS words,
         list_filter(string_split(text, chr(10)), lambda x : regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM base
), windows AS (
  SELECT rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM cut)
), repeats AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS c FROM windows) WHERE c > 1
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM
    (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM repeats) GROUP BY rid
), measured AS (
  SELECT doc_id, host, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM cut LEFT JOIN covered USING (rid)
), judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measured
), hosts AS (
  SELECT host, count(*) AS n, count(*) FILTER (base_failed) AS f FROM judged WHERE host IS NOT NULL GROUP BY host
), totals AS (
  SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) ** 2 AS v FROM hosts
), prior AS (
  SELECT m, CASE WHEN v > 0 THEN greatest({PRIOR_WEIGHT[0]}, least({PRIOR_WEIGHT[1]}, m * (1 - m) / v - 1))
                 ELSE {PRIOR_WEIGHT[1]} END AS w FROM totals
), gone AS (SELECT host FROM hosts, prior WHERE (f + m * w) / (n + w) > {MAX_HOST_RATE})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(host NOT IN (SELECT host FROM gone), TRUE) AS kept
FROM judged"""


ORACLE_SQL = _sql()

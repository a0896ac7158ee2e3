"""Benchmark decontamination by winnowing (native: DataFrame functions only).

Words are runs of letters, digits and non-ASCII characters, A-Z lowered. A window is ``window``
consecutive words of an item; an item of fewer words is one window. A document's words inside any
occurrence of a window are hit.

1. The fingerprint of a window is the smallest hash of the k-grams in it, so two equal windows have
   the same one wherever they stand: a shared span of at least a window is found for sure.
2. An item's fingerprints set bits in a map of fixed size. Of a document only the windows whose
   fingerprint hits the map go on; a larger benchmark lets more through and loses none.
3. Those meet the items' windows in a join on the fingerprint and on 128 bits over all words of the
   window, which extends a hit from its k-gram to the whole window. Overlapping windows are merged
   into the words that are hit.

A text is named by 128 bits of hash, so copies of a text are found once, and no id is needed.

Defined cases: a null or empty text has no words and meets nothing; repeated documents each get
their row; rows that share an item id are windows of one item; windows of an item with a null id
hit words but add no item; an empty table gives an empty result or documents without hits. Columns
other than ids and texts are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.common import bit_map, in_bit_map, stage

WINDOW = 10
KGRAM = 5
# The map of fingerprints: 65,536 longs.
_LONGS_BITS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Begins the second hash of what is named by two.
_MARK = 7


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), _BETWEEN), "")


def _grams(hashes: Column, k: int) -> Column:
    """A hash of each run of ``k`` words; null for fewer words."""
    places = F.sequence(F.lit(0), F.size(hashes) - k)
    run = lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(k)))
    return F.when(F.size(hashes) >= k, F.transform(places, run))


def _least(values: Column, span: int, reach: int) -> Column:
    """From the smallest of ``span`` neighbours to that of ``reach`` (at most twice as many)."""
    return F.transform(values, lambda x, i: F.least(x, F.get(values, i + (reach - span))))


def _fingerprints(df: DataFrame, length: int, kgram: int) -> DataFrame:
    """Adds ``prints``: the fingerprint of each run of ``length`` words of ``hashes``; null for
    fewer words. Steps double the span, so a fingerprint takes as many looks as its width has bits."""
    k = min(kgram, length)
    width, span = length - k + 1, 1
    out = df.withColumn("prints", _grams(F.col("hashes"), k))
    while span < width:
        reach = min(2 * span, width)
        out = out.withColumn("prints", _least(F.col("prints"), span, reach))
        span = reach
    whole = F.size("hashes") - (length - 1)
    return out.withColumn("prints", F.when(whole > 0, F.slice("prints", 1, whole)))


_PLACED = "array<struct<length:int,start:int,print:bigint>>"


def _window(length: int | Column, start: Column) -> list[Column]:
    run = F.slice("hashes", start + 1, length)
    return [F.xxhash64(run), F.xxhash64(F.lit(_MARK), run)]


def _lengths(df: DataFrame) -> list[int]:
    """At most as many values as a window has words."""
    return sorted(r["length"] for r in df.select("length").distinct().collect())


def item_windows(
    items: DataFrame, item_col: str = "item_id", text_col: str = "text", window: int = WINDOW, kgram: int = KGRAM
) -> DataFrame:
    """Distinct windows of the items: ``item``, ``length``, ``print``, ``first``, ``second``."""
    cut = items.select(F.col(item_col).alias("item"), _words(F.col(text_col)).alias("words"))
    hashed = cut.select("item", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    # Only items with fewer words have windows of other lengths.
    hashed = stage(hashed.withColumn("length", F.least(F.lit(window), F.size("hashes"))).where("length > 0"))
    parts = []
    for length in _lengths(hashed) or [window]:
        printed = _fingerprints(hashed.where(F.col("length") == length), length, kgram)
        # An outer explode: for a plain one Spark puts a filter before every step that made the prints,
        # with all steps nested in it.
        placed = printed.select("item", "hashes", F.posexplode_outer("prints").alias("start", "print"))
        placed = placed.where("print is not null")
        first, second = _window(length, F.col("start"))
        parts.append(
            placed.select("item", F.lit(length).alias("length"), "print", first.alias("first"), second.alias("second"))
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole.distinct()


def _read(docs: DataFrame, id_col: str, text_col: str, lengths: list[int], windows: DataFrame, kgram: int) -> DataFrame:
    """A row per document (``is_doc``) with its id, the two parts of its text's name and ``n_words``,
    and rows for those of its windows that may be an item's (``likely``). One pass, no shuffle."""
    text = F.col(text_col)
    out = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(text).alias("name"),
        F.xxhash64(F.lit(_MARK), text).alias("name2"),
        _words(text).alias("words"),
    )
    out = out.select(
        "doc_id", "name", "name2", F.coalesce(F.size("words"), F.lit(0)).cast("long").alias("n_words"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    for length in lengths:
        out = _fingerprints(out, length, kgram)
        placed = F.transform(
            "prints", lambda p, i: F.struct(F.lit(length).alias("length"), i.alias("start"), p.alias("print"))  # noqa: B023
        )
        out = out.withColumn(f"placed_{length}", F.coalesce(placed, F.array().cast(_PLACED)))
    every = F.concat(F.array().cast(_PLACED), *(f"placed_{length}" for length in lengths))
    out = out.select("doc_id", "name", "name2", "n_words", "hashes", F.posexplode_outer(every).alias("at", "w"))
    out = out.select("doc_id", "name", "name2", "n_words", "hashes", "at", "w.*")
    hit = in_bit_map(bit_map(windows.select("print"), _LONGS_BITS), F.col("print"), _LONGS_BITS)
    is_doc, likely = F.coalesce(F.col("at") == 0, F.lit(True)), F.coalesce(hit, F.lit(False))
    kept = out.where(is_doc | likely).withColumns({"is_doc": is_doc, "likely": likely})
    first, second = (F.when(F.col("likely"), h) for h in _window(F.col("length"), F.col("start")))
    return kept.select(
        "doc_id", "name", "name2", "n_words", "is_doc", "likely", "length", "start", "print",
        first.alias("first"), second.alias("second"),
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    kgram: int = KGRAM,
) -> DataFrame:
    """Per document ``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items`` (their ids as text,
    sorted) and ``contaminated``."""
    named = stage(item_windows(items, item_col, item_text_col, window, kgram))
    lengths = _lengths(named)
    windows = stage(named.select("length", "print", "first", "second").distinct())
    read = stage(_read(docs, id_col, text_col, lengths, windows, kgram))

    text = ["name", "name2"]
    spots = read.where("likely")
    same = ["length", "print", "first", "second"]
    hits = stage(spots.join(windows, same, "left_semi").select(*text, *same, "start").distinct())

    # The words under a text's windows: each window adds what lies past the ends of those before it.
    earlier = Window.partitionBy(*text).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    spans = hits.groupBy(*text, "start").agg((F.col("start") + F.max("length")).alias("end"))
    passed = F.greatest("start", F.coalesce(F.max("end").over(earlier), F.lit(0)))
    covered = spans.select(*text, F.greatest(F.lit(0), F.col("end") - passed).cast("long").alias("new"))
    n_hit = covered.groupBy(*text).agg(F.sum("new").alias("n_hit"))

    met = hits.select(*text, *same).distinct().join(named.where("item is not null"), same)
    found = met.select(*text, F.col("item").cast("string").alias("item")).distinct()
    listed = found.groupBy(*text).agg(F.sort_array(F.collect_list("item")).alias("items"))

    per_text = n_hit.join(listed, text, "left")
    out = read.where("is_doc").select("doc_id", *text, "n_words").join(per_text, text, "left")
    hit = F.coalesce("n_hit", F.lit(0))
    items_met = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        "doc_id",
        "n_words",
        hit.cast("long").alias("n_hit"),
        F.size(items_met).cast("long").alias("n_items"),
        items_met.alias("items"),
        (hit > 0).alias("contaminated"),
    )


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``decontaminate`` with the items' ids as one hash."""
    found = decontaminate(docs, items)
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ",").cast("binary"), 256)).drop("items")


ORACLE_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i : i + size - 1], ' ') AS span
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i
        FROM (SELECT *, least(10, len(words)) AS size FROM items WHERE len(words) > 0))
), spots AS (
  SELECT row, i, size, array_to_string(words[i : i + size - 1], ' ') AS span
  FROM (SELECT row, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM texts, (SELECT DISTINCT size FROM windows) sizes WHERE len(words) >= size)
), hits AS (
  SELECT row, i, size, item_id FROM spots JOIN windows USING (size, span)
), covered AS (
  SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + size)) AS p FROM hits) GROUP BY row
), listed AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS items
  FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN covered USING (row) LEFT JOIN listed USING (row)"""

"""Phrase collocations by partitioning (SON): mine shards, union, count globally.

Texts are lowered (A-Z), cut at punctuation and line ends into pieces and at blanks into words; all
is per language. A phrase of 2 to 4 words is a candidate when it occurs at least ``support`` times.

1. Words are counted exactly; a phrase with a rarer word than ``support`` cannot be frequent.
2. Every document belongs to one of ``SHARDS`` shards by its text. A shard with the part p of a
   language's words is mined completely at the local support p * ``support``: were a phrase below
   that in each shard, it would be below ``support`` in all. Mining goes level by level, as a longer
   phrase is locally frequent only if its pairs are. A shard is no task: tasks count what they read,
   and Spark adds up per shard and phrase, so shards may be of any size.
3. The union of the locally frequent phrases comes to the tasks as a bitmap of fixed size. Hits in it
   are counted again over all documents, by their words, so the counts are exact whatever the
   bitmap lets through; it only decides how much is counted for nothing.

Counts, cuts and the removal of phrases inside longer ones are joins over the frequent phrases.

Defined cases: a null text is empty and a null language is ``und``; repeated rows count each; an
empty table gives an empty result; columns other than text and language are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.common import shuffles_freed, stage

SUPPORT = 30
TOP = 2000
LONGEST = 4
# Of 100 occurrences so many inside one longer phrase make a phrase a part of that one.
INSIDE_PERCENT = 80
# At most 8, they take the low bits of a phrase's hash. Few shards keep local supports high.
SHARDS = 5
# Bits of a bitmap: 16 MB, whatever the input.
BITMAP_BITS = 27
# Words a task counts at once, and distinct words it remembers from one such count to the next.
CHUNK_WORDS = 3_000_000
MEMO_WORDS = 300_000
ROWS_OUT = 200_000

_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes(0x0A if c in _ENDS else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_OTHER = "und"


class _Words(dict):
    """Words to small numbers, 0 for the end of a piece and for words that are not ``wanted``."""

    def __init__(self, lang: str, wanted: np.ndarray | None) -> None:
        self.wanted, self.seed = wanted, _hash(lang.encode(), 0)
        self.names, self.hashes = [b""], [0]
        self[b"."] = 0

    def __missing__(self, word: bytes) -> int:
        h = 0 if self.wanted is None else _hash(word, self.seed) or 1
        number = len(self.names) if self.wanted is None or _bit(self.wanted, h) else 0
        if number:
            self.names.append(word)
            self.hashes.append(h)
        self[word] = number
        return number


def _hash(word: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(word, seed)


def _bit(bitmap: np.ndarray, h: int) -> int:
    at = h >> (64 - BITMAP_BITS)
    return int(bitmap[at >> 3]) >> (at & 7) & 1


def _bits(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class _Chunk:
    """What a task has read since it last counted: word numbers per language and shard."""

    def __init__(self, wanted: np.ndarray | None) -> None:
        self.wanted, self.words, self.parts, self.size = wanted, {}, {}, 0

    def add(self, lang: str | None, text: bytes | None) -> None:
        lang, text = lang if lang is not None else _OTHER, text or b""
        words = self.words.get(lang)
        if words is None:
            words = self.words[lang] = _Words(lang, self.wanted)
        tokens = (text.translate(_FOLD).replace(b"\n", b" . ") + b" .").split()
        numbers = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
        self.parts.setdefault((lang, zlib.crc32(text) % SHARDS), []).append(numbers)
        self.size += len(tokens)

    def groups(self) -> Iterator[tuple[str, int, np.ndarray]]:
        for (lang, shard), parts in self.parts.items():
            yield lang, shard, np.concatenate(parts)

    def clear(self) -> None:
        self.parts, self.size = {}, 0
        self.words = {k: w for k, w in self.words.items() if len(w) < MEMO_WORDS}


def _chunks(batches: Iterator[pa.RecordBatch], wanted: np.ndarray | None) -> Iterator[_Chunk]:
    chunk = _Chunk(wanted)
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
            chunk.add(lang, text)
            if chunk.size >= CHUNK_WORDS:
                yield chunk
                chunk.clear()
    if chunk.size:
        yield chunk


def _emit(names: list[str], columns: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays(columns, names)
    for at in range(0, whole.num_rows, ROWS_OUT):
        yield whole.slice(at, ROWS_OUT)


def _count_words(docs: DataFrame) -> DataFrame:
    """Per task: a language's words with counts, and rows without a word for what a shard holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, None):
            counts: dict[str, np.ndarray] = {}
            shares = []
            for lang, shard, numbers in chunk.groups():
                found = np.bincount(numbers, minlength=len(chunk.words[lang].names))
                shares.append((lang, shard, int(found[1:].sum())))
                counts[lang] = counts.get(lang, 0) + found
            for lang, found in counts.items():
                met = np.flatnonzero(found[1:]) + 1
                names = chunk.words[lang].names
                yield from _emit(
                    ["lang", "shard", "word", "n"],
                    [
                        pa.array([lang] * len(met), pa.string()),
                        pa.nulls(len(met), pa.int32()),
                        pa.array([names[k] for k in met], pa.binary()).cast(pa.string()),
                        pa.array(found[met], pa.int64()),
                    ],
                )
            langs, shards, sizes = zip(*shares)
            yield from _emit(
                ["lang", "shard", "word", "n"],
                [pa.array(langs, pa.string()), pa.array(shards, pa.int32()), pa.nulls(len(langs), pa.string()), pa.array(sizes, pa.int64())],
            )

    return docs.mapInArrow(run, "lang string, shard int, word string, n long")


def _whole(hashes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``k`` words, and which of them lie within one piece."""
    run, inside = hashes, hashes != 0
    for j in range(1, k):
        run, inside = _pair(run[:-1], hashes[j:]), inside[:-1] & (hashes[j:] != 0)
    return run, inside


def _runs(hashes: np.ndarray, sizes: tuple[int, ...], pairs: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per size the hashes of its runs and which of them count: those whose pairs are in ``pairs``."""
    if pairs is not None:
        two, inside = _whole(hashes, 2)
        likely = inside & _bits(pairs, two)
    for k in sizes:
        if len(hashes) < k:
            continue
        run, inside = _whole(hashes, k)
        if pairs is not None:
            for j in range(k - 1):
                inside = inside & likely[j : j + len(inside)]
        yield k, run, inside


def _mine(docs: DataFrame, sizes: tuple[int, ...], wanted, pairs, needs) -> DataFrame:
    """Hashes that are frequent in some shard, as ``key``: its low bits are the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _bitmap(wanted.value)
        likely = None if pairs is None else _bitmap(pairs.value)
        for chunk in _chunks(batches, known):
            for lang, shard, numbers in chunk.groups():
                hashes = np.array(chunk.words[lang].hashes, np.uint64)[numbers]
                for _, found, inside in _runs(hashes, sizes, likely):
                    keys = (found[inside] & ~np.uint64(7)) | np.uint64(shard)
                    keys, counts = np.unique(keys, return_counts=True)
                    need = np.full(len(keys), needs[lang, shard], np.int32)
                    yield from _emit(
                        ["key", "need", "n"],
                        [pa.array(keys.view(np.int64)), pa.array(need), pa.array(counts.astype(np.int32))],
                    )

    rows = docs.mapInArrow(run, "key long, need int, n int")
    # Tasks have added up already what they read, so rows go straight to where their key is added up.
    added = rows.repartition("key").groupBy("key").agg(F.sum("n").alias("n"), F.max("need").alias("need"))
    return added.where("n >= need").select("key")


def _count_phrases(docs: DataFrame, wanted, pairs, candidates) -> DataFrame:
    """Per task: phrases that may be candidates, with counts by their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, likely, chosen = (_bitmap(b.value) for b in (wanted, pairs, candidates))
        for chunk in _chunks(batches, known):
            for lang, _, numbers in chunk.groups():
                words = chunk.words[lang]
                hashes = np.array(words.hashes, np.uint64)[numbers]
                for k, found, inside in _runs(hashes, tuple(range(2, LONGEST + 1)), likely):
                    at = np.flatnonzero(inside)
                    if k > 2:
                        at = at[_bits(chosen, found[at])]
                    first, counts = _distinct(numbers, at, k)
                    phrases = [b" ".join([words.names[w] for w in numbers[p : p + k]]) for p in first]
                    yield from _emit(
                        ["lang", "k", "phrase", "n"],
                        [
                            pa.array([lang] * len(phrases), pa.string()),
                            pa.array([k] * len(phrases), pa.int32()),
                            pa.array(phrases, pa.binary()).cast(pa.string()),
                            pa.array(counts.astype(np.int64)),
                        ],
                    )

    return docs.mapInArrow(run, "lang string, k int, phrase string, n long")


def _distinct(numbers: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct run of ``k`` words that begins at these places, and how many do."""
    code = numbers[at]
    for j in range(1, k):
        _, code = np.unique(code, return_inverse=True)
        code = (code << 32) | numbers[at + j]
    _, first, counts = np.unique(code, return_index=True, return_counts=True)
    return at[first], counts


# Spark's bitmap aggregate covers so many places in one value.
_BLOCK = 15


def _collect_bits(keys: DataFrame):
    """A broadcast bitmap of the leading bits of ``key``; at most 2^BITMAP_BITS bits in any case."""
    at = keys.select(F.shiftrightunsigned("key", 64 - BITMAP_BITS).alias("at"))
    blocks = at.groupBy(F.shiftrightunsigned("at", _BLOCK).alias("block")).agg(
        F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit((1 << _BLOCK) - 1))).alias("bits")
    )
    size = 1 << (_BLOCK - 3)
    whole = bytearray(1 << (BITMAP_BITS - 3))
    for r in blocks.collect():
        whole[r["block"] * size : (r["block"] + 1) * size] = r["bits"]
    return keys.sparkSession.sparkContext.broadcast(bytes(whole))


def _bitmap(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint8)


def _word_keys(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, names = (c.cast(pa.binary()).to_pylist() for c in batch.columns)
            keys = [_hash(w, _hash(g, 0)) or 1 for g, w in zip(langs, names)]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys, np.uint64).view(np.int64))], ["key"])

    return words.select("lang", "phrase").mapInArrow(run, "key long")


def count(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT
) -> tuple[DataFrame, DataFrame]:
    """Exact counts of the phrases of 1 to 4 words that occur at least ``support`` times, as
    ``lang``, ``k``, ``phrase``, ``n``; and per language all its words, as ``lang``, ``n``."""
    with shuffles_freed(docs.sparkSession):
        return _count(docs, text_col, lang_col, support)


def _count(docs: DataFrame, text_col: str, lang_col: str, support: int) -> tuple[DataFrame, DataFrame]:
    plain = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    words = _count_words(plain).groupBy("lang", "shard", "word").agg(F.sum("n").alias("n"))
    words = stage(words.where(F.col("word").isNull() | (F.col("n") >= support)))
    frequent = words.where("word is not null").select(
        "lang", F.lit(1).alias("k"), F.col("word").alias("phrase"), "n"
    )
    shares = words.where("word is null")
    total = shares.groupBy("lang").agg(F.sum("n").alias("n"))
    # As many rows as there are languages and shards.
    by_lang: dict[str, int] = {r["lang"]: r["n"] for r in total.collect()}
    needs = {
        (r["lang"], r["shard"]): max(1, -(-support * r["n"] // max(1, by_lang[r["lang"]])))
        for r in shares.collect()
    }
    wanted = _collect_bits(_word_keys(frequent))
    pairs = _collect_bits(_mine(plain, (2,), wanted, None, needs))
    longer = _collect_bits(_mine(plain, tuple(range(3, LONGEST + 1)), wanted, pairs, needs))
    counted = _count_phrases(plain, wanted, pairs, longer).groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))
    phrases = stage(counted.where(F.col("n") >= support))
    return frequent.unionAll(phrases.select("lang", "k", "phrase", "n")), total


def _exact(column: str):
    return F.col(column).cast("decimal(20,0)")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    support: int = SUPPORT,
    top: int = TOP,
    inside_percent: int = INSIDE_PERCENT,
) -> DataFrame:
    """Each language's first ``top`` phrases: ``lang``, ``rank``, ``phrase``, ``a`` (occurrences),
    ``l``, ``r`` (those of the two parts of the weakest cut), ``n`` (words), ``score``."""
    counted, total = count(docs, text_col, lang_col, support)
    words = F.split("phrase", " ")
    whole = counted.where("k > 1").withColumn("words", words)
    slice_of = lambda start, length: F.array_join(F.slice("words", start, length), " ")

    cuts = whole.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).select(
        "lang", "phrase", F.col("n").alias("a"), "cut",
        slice_of(F.lit(1), F.col("cut")).alias("left"),
        slice_of(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"),
    )
    lefts = counted.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = counted.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    met = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"])
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(20,0))) div cast(l + r as decimal(20,0))")
    weakest = met.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "a", "l", "r")).alias("best")
    )

    longer = whole.where("k > 2").select("*", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("size"))
    longer = longer.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)).alias("start"))
    parts = longer.select("lang", slice_of(F.col("start"), F.col("size")).alias("phrase"), F.col("n").alias("around"))
    around = parts.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
    free = weakest.join(around, ["lang", "phrase"], "left").select("lang", "phrase", "best.*", "around")
    swallowed = 100 * _exact("around") >= inside_percent * _exact("a")
    free = free.where(F.col("around").isNull() | ~swallowed)

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), cut AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x : x <> '') AS words FROM pieces
), spots AS (
  SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM cut
), runs AS (
  SELECT lang, words, i, unnest([1, 2, 3, 4]) AS k FROM spots
), counted AS (
  SELECT lang, k, phrase, count(*) AS n FROM (
    SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase FROM runs WHERE i + k - 1 <= len(words)
  ) GROUP BY ALL HAVING count(*) >= 30
), total AS (
  SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM cut GROUP BY lang
), whole AS (
  SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM counted WHERE k > 1
), cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(w[1 : cut], ' ') AS left_part, array_to_string(w[cut + 1 : k], ' ') AS right_part
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM whole)
), scored AS (
  SELECT c.lang, c.phrase, a, f.n AS l, s.n AS r, cut,
         CAST((CAST(2000000 AS HUGEINT) * a) // (f.n + s.n) AS BIGINT) AS score
  FROM cuts c JOIN counted f ON f.lang = c.lang AND f.phrase = left_part
  JOIN counted s ON s.lang = c.lang AND s.phrase = right_part
), weakest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM scored)
  WHERE place = 1
), parts AS (
  SELECT lang, array_to_string(w[start : start + size - 1], ' ') AS phrase, max(a) AS around
  FROM (SELECT *, unnest(range(1, k - size + 2)) AS start FROM (SELECT *, unnest(range(2, k)) AS size FROM whole))
  GROUP BY ALL
), ranked AS (
  SELECT weakest.*, row_number() OVER (
           PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM weakest LEFT JOIN parts USING (lang, phrase)
  WHERE around IS NULL OR 100 * CAST(around AS HUGEINT) < 80 * CAST(a AS HUGEINT)
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang)
WHERE rank <= 2000"""

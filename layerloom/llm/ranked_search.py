"""Ranked lexical search: term at a time with a limited number of accumulators.

Terms are maximal runs of letters, digits and non-ASCII characters with A-Z lowered. A term's weight
falls with the number of documents that hold it, its part of a score grows with its occurrences and
falls with the document's length; all of it in whole numbers (``contract`` of ``search``).

Documents are indexed in shards of bounded size. In a shard an item's terms are taken rarest first:
each adds its part to the accumulator of every document that holds it, and makes new accumulators,
until what all the remaining terms could add is less than the k-th best partial score. From there no
new document can reach the result; accumulators that cannot either are let go, and the others
are still updated by every remaining term, so their scores are exact. The best k of all shards are
ranked in Spark.

Corpus numbers (documents, length, holders of each term) cover all rows. Items are the stated query
set: they are taken in blocks of a bounded number of (item, term) pairs, each against all documents.

Defined cases: a null or empty text has no term, so such a document or item meets nothing; rows
that share an item id are one item with the terms of all of them, a null item id included; repeated
documents are ranked one by one, equal scores by ascending id with null ids last; an empty
table gives an empty result. Columns other than the ids and the texts are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.common import stage

TOP = 10
# (item, term) pairs of one block of items, on average; what a block gives to every task.
BLOCK_PAIRS = 262_144
# A shard ends with the batch in which it has this many postings.
SHARD_POSTINGS = 2_000_000

_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(
    c if c in _WORD or c > 0x7F else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)
_LAST = np.iinfo(np.int64).max


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def _bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """Distinct (``item``, ``term``) pairs."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, terms = [], []
            for k, text in enumerate(_bytes(batch.column(1))):
                found = set(terms_of(text))
                ids += [k] * len(found)
                terms += found
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64())), pa.array(terms, pa.binary())], ["item", "term"]
            )

    kind = items.select(item_col).schema[0].dataType.simpleString()
    named = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))
    return named.mapInArrow(cut, f"item {kind}, term binary").distinct()


def _index(docs: DataFrame, term_ids: dict[bytes, int]) -> DataFrame:
    """Per document ``doc_id``, its number of terms ``n``, and the block's ``terms`` with ``tfs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ends, terms, tfs = [], [0], [], []
            for text in _bytes(batch.column(1)):
                words = terms_of(text)
                found = Counter(map(term_ids.get, words))
                found.pop(None, None)
                lengths.append(len(words))
                terms += found.keys()
                tfs += found.values()
                ends.append(len(terms))
            lists = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
                for values in (terms, tfs)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "tfs"]
            )

    return docs.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<int>")


class _Shard:
    """Postings of some documents by term: ascending document places and their impacts."""

    def __init__(self, batches: list[pa.RecordBatch], n_terms: int, n_docs: int, n_total: int) -> None:
        table = pa.Table.from_batches(batches).combine_chunks()
        ids = table["doc_id"].combine_chunks()
        self.unknown = np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(_LAST))
        lengths = np.asarray(table["n"])
        lists = [table[c].combine_chunks() for c in ("terms", "tfs")]
        lists = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in lists]
        sizes = np.diff(np.asarray(lists[0].offsets))
        term, tf = (np.asarray(c.flatten()).astype(np.int64) for c in lists)
        place = np.repeat(np.arange(len(self.ids)), sizes)
        order = np.argsort(term, kind="stable")
        self.docs, tf = place[order], tf[order]
        m = 100 - 90 + (90 * lengths * n_docs) // max(n_total, 1)
        self.impacts = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.docs])
        self.starts = np.searchsorted(term[order], np.arange(n_terms + 1))

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the best ``k`` documents for terms that come rarest first."""
        spans = [(int(w), int(self.starts[t]), int(self.starts[t + 1])) for t, w in zip(terms, weights)]
        spans = [s for s in spans if s[0] > 0 and s[1] < s[2]]
        bounds = [w * int(self.impacts[a:b].max()) for w, a, b in spans]
        rest, reached = sum(bounds), 0
        partial = np.zeros(len(self.ids), np.int64)
        alive = None
        for (w, a, b), bound in zip(spans, bounds):
            docs, parts = self.docs[a:b], w * self.impacts[a:b]
            rest, reached = rest - bound, reached + bound
            if alive is None:
                partial[docs] += parts
                # A partial score is at most ``reached``: below that the rest may be too little.
                if rest < reached:
                    made = np.flatnonzero(partial)
                    floor = _kth(partial[made], k)
                    if floor is not None and rest < floor:
                        alive = made[partial[made] + rest >= floor]
            else:
                at = np.searchsorted(docs, alive)
                met = docs[np.minimum(at, len(docs) - 1)] == alive
                partial[alive[met]] += parts[at[met]]
        found = np.flatnonzero(partial) if alive is None else alive
        scores = partial[found]
        floor = _kth(scores, k)
        if floor is not None:
            found, scores = found[scores >= floor], scores[scores >= floor]
        order = np.lexsort((self.ids[found], -scores))[:k]
        return found[order], scores[order]


def _kth(scores: np.ndarray, k: int) -> int | None:
    return int(np.partition(scores, len(scores) - k)[-k]) if len(scores) >= k else None


def _score(index: DataFrame, queries: list[tuple[np.ndarray, np.ndarray]], n_terms: int, n_docs: int, n_total: int, k: int, postings: int) -> DataFrame:
    """The best ``k`` of every shard per query: ``query`` (its place in the list), ``doc_id``, ``score``."""

    def answer(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        shard = _Shard(rows, n_terms, n_docs, n_total)
        found = [shard.best(terms, weights, k) for terms, weights in queries]
        places = np.concatenate([p for p, _ in found])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(queries)), [len(p) for p, _ in found]), pa.int32()),
                pa.array(shard.ids[places], pa.int64(), mask=shard.unknown[places]),
                pa.array(np.concatenate([s for _, s in found]), pa.int64()),
            ],
            ["query", "doc_id", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            rows.append(batch)
            held += len(batch.column(2).flatten()) + batch.num_rows
            if held >= postings:
                yield answer(rows)
                rows, held = [], 0
        if held:
            yield answer(rows)

    return index.mapInArrow(run, "query int, doc_id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_pairs: int = BLOCK_PAIRS,
    shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score`` of the ``k`` best documents with a score above 0.

    With N documents that have a term, L terms in all, n in a document, df documents that hold a
    term and tf occurrences in one: w = floor(1000 ln((2N + 2) / (2df + 1))), m = 10 + 90nN div L,
    and a score is the sum of w * (10^9 tf div (1000 tf + 8m)) over the item's terms.
    """
    spark = docs.sparkSession
    pairs = stage(_item_terms(items, item_col, item_text_col))
    n_blocks = max(1, -(-pairs.count() // block_pairs))
    block_of = F.pmod(F.xxhash64("item"), F.lit(n_blocks))
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = [
        stage(_block(plain, pairs.where(block_of == b), k, shard_postings)) for b in range(n_blocks)
    ]
    best = parts[0]
    for part in parts[1:]:
        best = best.unionAll(part)
    first = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return ranked.select(F.col("item").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _block(docs: DataFrame, pairs: DataFrame, k: int, shard_postings: int) -> DataFrame:
    """What the shards give for one block of items: ``item``, ``doc_id``, ``score``."""
    spark = docs.sparkSession
    kind = pairs.schema["item"].dataType
    # At most a block: its size is a parameter, or the distinct terms of a single item.
    rows = [(r["item"], bytes(r["term"])) for r in pairs.collect()]
    term_ids = {t: n for n, t in enumerate(sorted({t for _, t in rows}))}
    index = stage(_index(docs, term_ids))
    totals = index.agg(F.count_if(F.col("n") > 0).alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_total")).first()
    n_docs, n_total = totals["n_docs"], totals["n_total"]
    held = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    df = np.zeros(len(term_ids), np.int64)
    for r in held.collect():
        df[r["term"]] = r["df"]
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df]
    grouped: dict = {}
    for item, term in rows:
        grouped.setdefault(item, []).append(term_ids[term])
    names, queries = [], []
    for item, terms in grouped.items():
        held_here = sorted((int(df[t]), t) for t in terms if df[t])
        names.append((len(names), item))
        order = np.array([t for _, t in held_here], np.int64)
        queries.append((order, np.array([weight[t] for t in order], np.int64)))
    scored = _score(index, queries, len(term_ids), n_docs, n_total, k, shard_postings) if queries else None
    named = spark.createDataFrame(names, f"query int, item {kind.simpleString()}")
    if scored is None:
        return named.select("item", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("score"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = scored.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k)
    return top.join(named, "query").select("item", "doc_id", "score")


ORACLE_SQL = r"""
WITH cut AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
  FROM documents
), wanted AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
  FROM benchmark
), held AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM cut)
  WHERE term IN (SELECT term FROM wanted) GROUP BY row, term
), corpus AS (
  SELECT CAST(count(*) FILTER (len(terms) > 0) AS BIGINT) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_total FROM cut
), lengths AS (
  SELECT row, doc_id, 100 - 90 + (90 * len(terms) * n_docs) // n_total AS m FROM cut, corpus
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM held, corpus GROUP BY term, n_docs
), scored AS (
  SELECT item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM wanted JOIN held USING (term) JOIN weights USING (term) JOIN lengths USING (row)
  GROUP BY item_id, row, doc_id
)
SELECT item_id, CAST(place AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0
) WHERE place <= 10"""

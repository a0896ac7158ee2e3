"""Exact top-k by integer inner product over a pivot-distance index.

Every vector is keyed by its nearest pivot and its distance from it, cut into rings. A ring around
a pivot is an annulus; its directory row holds the bounds of distance and length of its vectors.
For a query the triangle inequality bounds the distance to an annulus from below, hence the inner
product from above: 2<q,x> = |q|^2 + |x|^2 - |q-x|^2. First a query looks into its best annuli
until it has enough candidates; the k-th best score found is a floor. Then it looks into every
annulus whose bound reaches the floor, and no other can hold a better or equal score.

Annuli with many vectors (equal vectors all share one) are cut into blocks, each met by itself, so
no task holds more than a block and the queries sent to it in one chunk. Pivots are a bounded,
deterministic sample; every vector is indexed.

Components are floor(256 * x), held at the ends of a 64-bit integer. Scores are exact: products are
added in floating point only where every partial sum is a whole number below 2^53, else in 64-bit
integers where they fit, else in integers of any size; a score beyond 64 bits is given, and ranked,
as the end of their range. Rings are a fixed number of parts of the largest distance, so the
directory is bounded whatever the vectors' scale.

Defined cases: rows whose id is null, and vectors that are null or hold a null or a component
that is not finite, take no part; shorter vectors count as filled up with zeros; rows that share an
id are candidates each but none is one for a query of that id; ties go to the smaller id; an empty
table gives an empty result. Only the id and the vector are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.common import stage

SCALE = 256
PIVOTS = 96
# Rings around a pivot, from distance 0 to the largest distance of all.
RINGS = 64
# Vectors in a block, and queries met with it at once.
BLOCK = 512
QUERIES = 512
# Queries sent to one copy of a block.
CHUNK = 8192
# Times k: candidates that set a query's floor.
ENOUGH = 20


def clean(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and the scaled vector ``v`` of the rows that take part."""
    x = F.col(vector_col)
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    scaled = F.transform(x, lambda e: F.floor(e.cast("double") * SCALE))
    # A null array fails the test, as does one with a null component.
    taken = F.coalesce(whole, F.lit(False)) & F.col(id_col).isNotNull()
    return vectors.where(taken).select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("v"))


def _matrix(column: pa.Array, dim: int, kind: type = np.float64) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    sizes = np.diff(column.offsets.to_numpy())
    if len(flat) == len(sizes) * dim and (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), kind)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


# The ends of a score's range.
_END = 2**63 - 1


def _exact_kind(q: np.ndarray, x: np.ndarray) -> type:
    """The numbers in which all inner products of these rows are exact."""
    largest = max(1, x.shape[1]) * float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0))
    # Kept well below the limits, as the estimate itself is rounded.
    return np.float64 if largest < 2.0**52 else np.int64 if largest < 2.0**62 else object


def _to_long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype != object:
        return scores.astype(np.int64)
    return np.clip(scores, -_END, _END).astype(np.int64)


def index(found: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Key every vector: nearest ``pivot``, ``distance`` from it and the squared length ``square``."""
    dim = pivots.shape[1]

    def key(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("v"), dim)
            d = _distances(x, pivots)
            near = d.argmin(1)
            d = d[np.arange(len(x)), near]
            columns = [near.astype(np.int32), d, (x * x).sum(1)]
            yield pa.record_batch(
                [*batch.columns, *map(pa.array, columns)], names=["vec_id", "v", "pivot", "distance", "square"]
            )

    return found.mapInArrow(key, "vec_id long, v array<long>, pivot int, distance double, square double")


class _Directory:
    """Bounds of all annuli, sorted by pivot and ring; at most pivots times rings."""

    def __init__(self, rows: pd.DataFrame, pivots: np.ndarray):
        rows = rows.sort_values(["pivot", "ring"])
        self.pivots, self.n = pivots, rows["n"].to_numpy()
        self.pivot, self.ring = rows["pivot"].to_numpy(), rows["ring"].to_numpy()
        self.low, self.high = rows["low"].to_numpy(), rows["high"].to_numpy()
        self.square = rows["square"].to_numpy()
        # Blocks of each pivot that has vectors.
        self.named, self.first = np.unique(self.pivot, return_index=True)
        self.blocks = -(-np.add.reduceat(self.n, self.first) // BLOCK)

    def bounds(self, x: np.ndarray, of: slice = slice(None)) -> np.ndarray:
        """Largest inner product that each query can reach in each annulus."""
        d = _distances(x, self.pivots)[:, self.pivot[of]]
        gap = np.maximum(d - self.high[of], self.low[of] - d)
        # Distances are rounded, by a part of the lengths they are taken from; the slack keeps the
        # bound a bound.
        q = (x * x).sum(1)[:, None]
        lengths = np.sqrt(q) + np.sqrt(self.square[of]) + np.sqrt((self.pivots**2).sum(1))[self.pivot[of]]
        gap = np.maximum(0, gap - 1e-6 * (1 + d + lengths))
        by_distance = (q + self.square[of] - gap * gap) / 2
        by_length = np.sqrt(q * self.square[of])
        return np.minimum(by_distance, by_length) + 1e-9 * (q + self.square[of]) + 1e-6

    def first_floor(self, bounds: np.ndarray, enough: int) -> np.ndarray:
        """Per query the bound of the last annulus it needs, best first, for so many candidates."""
        order = np.argsort(-bounds, axis=1)
        held = np.cumsum(self.n[order], axis=1)
        last = np.minimum((held < enough).sum(axis=1), bounds.shape[1] - 1)
        rows = np.arange(len(bounds))
        return bounds[rows, order[rows, last]]


VISIT = "pivot int, block int, chunk int, query_id long, q array<long>, floor double"
FOUND = "query_id long, vec_id long, score long"


def _visits(queries: DataFrame, directory: _Directory, dim: int, chunks: int, enough: int) -> DataFrame:
    """A row per query and block of the pivots it must look at. ``floor`` of a query may be null:
    then it is set so that ``enough`` candidates are seen."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, QUERIES):
                batch = whole.slice(at, QUERIES)
                bounds = directory.bounds(_matrix(batch.column("v"), dim))
                floor = batch.column("floor").to_numpy(zero_copy_only=False).astype(np.float64)
                floor = np.where(np.isnan(floor), directory.first_floor(bounds, enough), floor)
                wanted = np.logical_or.reduceat(bounds >= floor[:, None], directory.first, axis=1)
                query, pivot = np.nonzero(wanted)
                each = directory.blocks[pivot]
                block = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                query, pivot = np.repeat(query, each), directory.named[np.repeat(pivot, each)]
                taken = batch.take(pa.array(query))
                yield pa.record_batch(
                    [
                        pa.array(pivot.astype(np.int32)),
                        pa.array(block.astype(np.int32)),
                        taken.column("chunk"),
                        taken.column("vec_id"),
                        taken.column("v"),
                        pa.array(floor[query]),
                    ],
                    names=["pivot", "block", "chunk", "query_id", "q", "floor"],
                )

    chunk = F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk")
    return queries.select("vec_id", "v", "floor", chunk).mapInArrow(send, VISIT)


def _meet(blocks: DataFrame, visits: DataFrame, directory: _Directory, dim: int, k: int) -> DataFrame:
    """The ``k`` best of each block for each query that visits it: annulus by annulus, only those
    whose bound reaches the query's floor."""

    def score(members: pa.Table, visitors: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if members.num_rows and visitors.num_rows:
            members = members.sort_by("vec_id").combine_chunks()
            visitors = visitors.combine_chunks()
            x = _matrix(_one(members, "v"), dim)
            ids, rings = members["vec_id"].to_numpy(), members["ring"].to_numpy()
            k_pivot = int(np.searchsorted(directory.named, members["pivot"][0].as_py()))
            low = directory.first[k_pivot]
            high = directory.first[k_pivot + 1] if k_pivot + 1 < len(directory.first) else len(directory.n)
            of = slice(low, high)
            for at in range(0, visitors.num_rows, QUERIES):
                part = visitors.slice(at, QUERIES)
                q, query = _matrix(_one(part, "q"), dim), part["query_id"].to_numpy()
                wanted = directory.bounds(q, of) >= part["floor"].to_numpy()[:, None]
                kind = _exact_kind(q, x)
                if kind is not np.float64:
                    q, exact = (_matrix(_one(t, c), dim, np.int64).astype(kind) for t, c in ((part, "q"), (members, "v")))
                else:
                    exact = x
                scores, seen = np.zeros((len(q), len(x)), np.int64), np.zeros((len(q), len(x)), bool)
                for ring in np.unique(rings):
                    mine = rings == ring
                    who = wanted[:, np.searchsorted(directory.ring[of], ring)]
                    if who.any():
                        scores[np.ix_(who, mine)] = _to_long(q[who] @ exact[mine].T)
                        seen[np.ix_(who, mine)] = True
                seen &= query[:, None] != ids
                # Members are in order of id, so a stable sort settles ties; what was not seen is last.
                best = np.lexsort((-scores, ~seen), axis=1)[:, :k]
                row, column = np.nonzero(np.take_along_axis(seen, best, axis=1))
                place = best[row, column]
                for held, new in zip(out, (query[row], ids[place], scores[row, place])):
                    held.append(new)
        names = ["query_id", "vec_id", "score"]
        return pa.table({n: pa.array(np.concatenate(c) if c else [], pa.int64()) for n, c in zip(names, out)})

    key = ["pivot", "block", "chunk"]
    return blocks.groupBy(*key).cogroup(visits.groupBy(*key)).applyInArrow(score, FOUND)


def _one(table: pa.Table, name: str) -> pa.Array:
    column = table[name].combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    n_pivots: int = PIVOTS,
    rings: int = RINGS,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score``: the ``k`` best of each id for
    which ``is_query`` (a condition on ``vec_id``) holds. Of rows that share such an id, the
    smallest vector asks."""
    spark = vectors.sparkSession
    found = stage(clean(vectors, id_col, vector_col))
    # The pivots: bounded, spread by a hash, the same in every run.
    chosen = found.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(n_pivots).select("v").collect()
    if not chosen:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim = max(1, found.agg(F.max(F.size("v"))).first()[0])
    pivots = np.zeros((len(chosen), dim))
    for row, (v,) in zip(pivots, chosen):
        row[: len(v)] = v
    pivots = np.unique(pivots, axis=0)
    keyed = stage(index(found, pivots))
    widest = keyed.agg(F.max("distance")).first()[0]
    ring = F.least(F.lit(rings - 1), F.floor(F.col("distance") * rings / F.lit(widest or 1.0))).cast("int")
    keyed = keyed.withColumn("ring", ring)
    annuli = keyed.groupBy("pivot", "ring").agg(
        F.count("*").alias("n"),
        F.min("distance").alias("low"),
        F.max("distance").alias("high"),
        F.max("square").alias("square"),
    )
    directory = _Directory(annuli.toPandas(), pivots)
    queries = stage(found.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")))
    chunks = 1 + queries.count() // CHUNK
    # The blocks of a pivot by hash, each repeated for every chunk of queries.
    of_pivot = dict(zip(directory.named.tolist(), directory.blocks.tolist()))
    count = F.element_at(F.array(*(F.lit(of_pivot.get(p, 1)) for p in range(len(pivots)))), F.col("pivot") + 1)
    block = F.pmod(F.xxhash64("vec_id", "v"), count).cast("int").alias("block")
    each = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    blocks = keyed.select("pivot", "ring", "vec_id", "v", block, each)

    unknown = queries.withColumn("floor", F.lit(None).cast("double"))
    first = _best(_meet(blocks, _visits(unknown, directory, dim, chunks, ENOUGH * k), directory, dim, k), k)
    floors = first.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.when((F.count("*") >= k) & (F.min("score") > -_END), F.min("score").cast("double")).alias("floor")
    )
    # Without k candidates so far, everything must be seen.
    floor = F.coalesce("floor", F.lit(float("-inf"))).alias("floor")
    limited = stage(queries.join(floors, "vec_id", "left").select("vec_id", "v", floor))
    met = _meet(blocks, _visits(limited, directory, dim, chunks, 0), directory, dim, k)
    return _best(met, k).select("query_id", "rank", "vec_id", "score")

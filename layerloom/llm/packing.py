"""Best-fit packing planned over the histogram of lengths.

Documents are encoded once and cut into pieces of at most one sequence; only their lengths and
digests go on. The plan is made over counts per length, longest first: a piece goes where it leaves
the least room. Bins with equal room are interchangeable, so the plan holds runs of bins, and a
plan row says: the pieces of this length with ranks from ``low`` to ``high`` go one each into the
bins from ``bin`` on, at ``offset``. Its size is bound by the sequence length, not by the data.
Pieces take their slots by joining on length and rank.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; a null id
is packed like any other; an empty table gives an empty result. Columns other than the id and the
text are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.byte_bpe import END_ID, KEEP, encoder
from layerloom.llm.common import shuffle_partitions, stage

CAPACITY = 2048
# Documents that go to a Python worker at once.
ARROW_ROWS = 2500
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLAN = "length long, low long, high long, bin long, offset long"


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: int = KEEP,
) -> DataFrame:
    """One row per piece. A text longer than a sequence fills whole sequences from its end; the
    rest is its first piece. No shuffle."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer, keep=keep)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            rows = []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), code.run(batch.column("text"))):
                ids = np.concatenate([ids, end])
                n = len(ids)
                edges = [*range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip([0, *edges], edges)):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            columns = [*zip(*rows)] or [()] * 5
            types = [pa.int64(), pa.int32(), *[pa.int64()] * 3]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(cut, PIECES)


def plan(histogram: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows (length, low, high, bin, offset)."""
    rows: list[tuple[int, int, int, int, int]] = []
    rooms: list[int] = []  # sorted rooms for which there are bins
    runs: dict[int, list[tuple[int, int]]] = {}  # room -> runs of bins (first, count)
    bins = 0

    def keep(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in runs:
                runs[room] = []
                insort(rooms, room)
            runs[room].append((first, count))

    def take(room: int) -> tuple[int, int]:
        run = runs[room].pop()
        if not runs[room]:
            del runs[room]
            rooms.remove(room)
        return run

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, count = take(room)
                each = room // length
            else:
                room, each = capacity, capacity // length
                first, count = bins, max(1, left // each)
                bins += count
            if left >= each:  # fill as many bins of this run as there are pieces for
                used, deep = min(count, left // each), each
            else:
                used, deep = 1, left
            for k in range(deep):
                rows.append((length, rank, rank + used, first, capacity - room + k * length))
                rank += used
            left -= used * deep
            keep(room - deep * length, first, used)
            keep(room, first + used, count - used)
    return rows


def assign(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give each piece of ``found`` (staged: it is read twice) its sequence and offset.

    A rank within a length is a place within a bucket of that length plus the sizes of the buckets
    before it, so a length that a third of all pieces have is ranked in many tasks. Buckets are dealt
    by the staged ``lane``, a number of the row, so copies of one row are spread as well. The
    histogram on the driver has at most ``capacity`` rows.
    """
    spark = found.sparkSession
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.createDataFrame(plan(histogram, capacity), PLAN)
    buckets = 2 * shuffle_partitions(spark)
    keyed = found.withColumn("bucket", F.pmod(F.xxhash64("lane"), F.lit(buckets)))
    sizes = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    spans = sizes.select("length", "bucket", "n", before.alias("before")).alias("s")
    p = slots.alias("p")
    meets = (F.col("p.length") == F.col("s.length")) & (F.col("p.low") < F.col("before") + F.col("n"))
    met = spans.join(p, meets & (F.col("p.high") > F.col("before")))
    slot = F.struct("p.low", "p.high", "p.bin", "p.offset")
    each = met.groupBy("s.length", "s.bucket", "before").agg(F.collect_list(slot).alias("slots"))
    place = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "lane")) - 1
    ranked = keyed.withColumn("place", place.cast("long")).join(each, ["length", "bucket"])
    rank = F.col("before") + F.col("place")
    chosen = F.filter("slots", lambda s: (s["low"] <= F.col("rank")) & (F.col("rank") < s["high"]))[0]
    taken = ranked.withColumn("rank", rank).withColumn("slot", chosen)
    return taken.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("slot.bin") + F.col("rank") - F.col("slot.low")).alias("sequence_id"),
        F.col("slot.offset").alias("offset"),
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: int = KEEP,
    arrow_rows: int = ARROW_ROWS,
) -> DataFrame:
    """Pieces of all documents with their sequences and offsets. ``keep`` and ``arrow_rows`` trade
    the memory of Python workers for speed."""
    cut = pieces(docs, tokenizer, capacity, id_col, text_col, keep)
    return assign(stage(cut.withColumn("lane", F.monotonically_increasing_id()), arrow_rows), capacity)

"""Language by rank-order profiles of character n-grams.

Training counts the 1- to 3-grams of all learning documents per language in Spark and keeps the
most frequent of each language, in order: its profile. A document's own most frequent n-grams, in
order, are held against each profile: the out-of-place distance is the sum of the differences in
rank, where an n-gram the profile lacks counts as far as the profile is long. The nearest profile
wins, the smaller language name in a tie.

Texts are read whole, in lower case; a run of other characters than letters is one word boundary.
The score is 1 less the distance over the largest one possible, between 0 and 1.

Defined cases: a text that is null or has no letter is ``und`` with score 0, and so is every text if
nothing could be learned; rows with a null language or id are not learned from; repeated rows count
each; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from layerloom.llm.byte_bpe import slices
from layerloom.llm.common import stage

# N-grams in a profile. What the driver and each task hold is this many per language.
PROFILE = 300
UNKNOWN = "und"
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> np.ndarray:
    """Codes of all 1- to 3-grams; 0 stands for a word boundary. Empty without a letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    points = np.where(_letters()[points], points, 0)
    points = np.concatenate([[0], points, [0]])
    # One boundary between words.
    points = points[np.append(True, (points[1:] != 0) | (points[:-1] != 0))]
    if len(points) < 2:
        return points[:0]
    one = points[points > 0]
    two = -1 - (points[:-1] << 21 | points[1:])
    three = points[:-2] << 42 | points[1:-1] << 21 | points[2:]
    return np.concatenate([one, two, three[points[1:-1] > 0]])


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        at = 0
        for part in slices(batch.column("text")):
            mine = langs[at : at + len(part)]
            at += len(part)
            found = [grams(t) for t in part.to_pylist()]
            for lang in sorted(set(mine)):
                every = np.concatenate([g for g, x in zip(found, mine) if x == lang])
                codes, n = np.unique(every, return_counts=True)
                columns = [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)]
                yield pa.record_batch(columns, names=["lang", "gram", "n"])


def learn(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE
) -> dict[str, list[int]]:
    """Profiles of all languages in ``docs``: their most frequent n-grams in order.

    N-grams are counted before they move. Of a language only the first ``size`` of each task go on
    to the final ranking, and ``size`` rows per language come to the driver.
    """
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).na.drop()
    counted = rows.mapInArrow(_counts, "lang string, gram long, n long")
    totals = stage(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for row in ranked.orderBy("lang", "rank").collect():
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


class Ranker:
    """Out-of-place distance of texts to the profiles."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE):
        self.langs, self.size = sorted(profiles), size
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, np.int64)
        for k, lang in enumerate(self.langs):
            self.ranks[k, np.searchsorted(self.grams, profiles[lang])] = np.arange(len(profiles[lang]))

    def __call__(self, text: str | None) -> tuple[str, float]:
        found = grams(text)
        if not len(found) or not self.langs:
            return UNKNOWN, 0.0
        codes, n = np.unique(found, return_counts=True)
        if len(codes) > self.size:
            # All that may be among the first: ties at the edge are sorted out below.
            edge = np.partition(n, len(n) - self.size)[len(n) - self.size]
            codes, n = codes[n >= edge], n[n >= edge]
        top = codes[np.lexsort((codes, -n))][: self.size]
        at = np.minimum(np.searchsorted(self.grams, top), len(self.grams) - 1)
        at = np.where(self.grams[at] == top, at, len(self.grams))
        ranks = self.ranks[:, at]
        places = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(top))))
        distance = places.sum(axis=1)
        best = int(distance.argmin())
        return self.langs[best], 1.0 - float(distance[best]) / (self.size * len(top))


def predict(
    docs: DataFrame,
    profiles: dict[str, list[int]],
    size: int = PROFILE,
    keep: tuple[str, ...] = ("doc_id",),
    text_col: str = "text",
) -> DataFrame:
    """``keep`` columns with ``lang_pred`` and ``score``. No shuffle."""
    rank = Ranker(profiles, size)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in slices(batch.column(0)):
                found = [rank(t) for t in part.to_pylist()]
                kept = [batch.column(k + 1).slice(at, len(part)) for k in range(len(keep))]
                new = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                yield pa.record_batch([*kept, *new], names=[*keep, "lang_pred", "score"])
                at += len(part)

    picked = docs.select(F.col(text_col).alias("_text"), *keep)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return picked.mapInArrow(run, f"{types}, lang_pred string, score double")


def held_out(folds: int, fold: int):
    """Whether the document is kept from learning; null ids are neither held out nor learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == fold

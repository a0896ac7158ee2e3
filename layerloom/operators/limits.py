"""Row caps and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Keys of one bucket, and sub-buckets of the rows of one key.
BUCKET = 65_536
_HASH_SHIFT = 48
_BEFORE_ALL = -(2**63)
# Equal rows that are written out from one array at most.
_COPIES = 65_536


def first_rows(df: DataFrame, limit: int | None, key: str, within: str | None = None) -> DataFrame:
    """The ``limit`` rows with the lowest ``key``, a whole number: ``None`` keeps all, ``0`` none.

    With ``within`` that many of each of its values, which must be few (years). Files have no row
    order once they are read in parallel, so the order is spelled out: null keys first, then by key,
    then by a hash of the row.

    The row at which the limit falls is closed in on by counting: first its bucket of keys, in it
    its key, of that key's rows its sub-bucket by hash. Each count is combined before it moves, and
    what lies below is kept as it is. Only the different rows of one sub-bucket are ranked, their
    copies counted, so neither a null nor any other key with a third of all rows meets in one task.
    """
    if limit is None:
        return df
    group = F.lit(0) if within is None else F.col(within)
    number = F.coalesce(F.col(key).cast("long"), F.lit(_BEFORE_ALL))
    bucket = F.coalesce(F.floor(F.col(key) / BUCKET).cast("long"), F.lit(_BEFORE_ALL))
    codes = [bucket, number, F.shiftright(F.xxhash64(*df.columns), _HASH_SHIFT)]
    placed = df.select("*", group.alias("_group"), *(c.alias(f"_code{k}") for k, c in enumerate(codes)))
    below, inside, left = F.lit(False), F.lit(True), F.lit(limit).cast("long")
    for code in (F.col(f"_code{k}") for k in range(len(codes))):
        edge = F.try_element_at(_edges(placed.where(inside), code, left).scalar(), F.col("_group"))
        # A group without an edge has no more rows than it may keep.
        below = below | (inside & (edge.isNull() | (code < edge["at"])))
        inside = inside & F.coalesce(code == edge["at"], F.lit(False))
        left = edge["left"]
    whole = placed.where(below).select(*df.columns)
    return whole.unionAll(_ranked(placed.where(inside).withColumn("_left", left), df.columns))


def _edges(rows: DataFrame, code: Column, left: Column) -> DataFrame:
    """One row with a map: per group the code ``at`` which it has its ``left`` rows, and how many of
    them are ``left`` to take there."""
    sizes = rows.select("_group", code.alias("_code"), left.alias("_left")).groupBy("_group", "_left", "_code")
    lower = Window.partitionBy("_group").orderBy("_code").rowsBetween(Window.unboundedPreceding, -1)
    counted = sizes.agg(F.count("*").alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(lower), F.lit(0)))
    edge = counted.where((F.col("_before") <= F.col("_left")) & (F.col("_before") + F.col("_n") > F.col("_left")))
    place = F.struct(F.col("_code").alias("at"), (F.col("_left") - F.col("_before")).alias("left"))
    return edge.agg(F.map_from_entries(F.collect_list(F.struct("_group", place))).alias("edges"))


def _ranked(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The first ``_left`` rows of each group by hash; equal rows are ranked as one and counted."""
    same = rows.groupBy("_group", "_left", *columns).agg(F.count("*").alias("_n"))
    lower = Window.partitionBy("_group").orderBy(F.xxhash64(*columns)).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(lower), F.lit(0))
    taken = same.withColumn("_n", F.least(F.col("_n"), F.col("_left") - before)).where("_n > 0")
    lots = taken.select(*columns, "_n", F.explode(F.expr(f"sequence(0, (_n - 1) div {_COPIES})")).alias("_lot"))
    size = F.least(F.lit(_COPIES).cast("long"), F.col("_n") - F.col("_lot") * _COPIES)
    return lots.select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), size)).alias("_copy")).select(*columns)


def preview(df: DataFrame, limit: int = 20) -> DataFrame:
    """Any ``limit`` rows; stops reading as soon as it has them."""
    return df.limit(limit)


def top_rows(df: DataFrame, measure: str, k: int, *tie_break: str) -> DataFrame:
    """The ``k`` rows with the highest ``measure``; ties are settled by ``tie_break``."""
    return df.orderBy(F.col(measure).desc(), *tie_break).limit(k)

"""Keyed upserts as pure functions over two frames.

There is one plan for every batch. The table is the left side of its join, so Spark broadcasts the
batch's keys when they are small and adaptive execution splits a table key with very many rows when
they are not. To leave alone what a batch cannot touch, partition the table by ranges of its key
(``sources.tables.upsert_ranges``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLAIMS = "_claims"


def anti_unchanged(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Existing rows the batch does not replace, in their own column order.

    A null key equals nothing, so such rows are always kept; NaN equals NaN, and -0.0 equals 0.0.
    """
    kept = existing.join(_keys(incoming, keys), list(keys), "left_anti")
    return kept.select(*existing.columns)


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace whole rows by key and add the new ones.

    Rows are replaced whole: a column the batch lacks becomes null on the rows it replaces. A
    column only the batch has is added and is null on the rows that stay. All incoming rows are
    kept, also those that share a key.
    """
    kept = anti_unchanged(existing, incoming, keys)
    return kept.unionByName(incoming, allowMissingColumns=True)


def merge_into(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], strict: bool = False
) -> DataFrame:
    """``upsert`` under the rules of SQL ``MERGE``.

    The batch must have every column of the table. The job that computes the result fails when
    several incoming rows match the same existing row; with ``strict`` also when they share a key
    nothing matches. That check rides on the join, there is no separate pass.
    """
    have = {c.lower() for c in incoming.columns}
    missing = [c for c in existing.columns if c.lower() not in have]
    if missing:
        raise ValueError(f"the batch lacks columns of the table: {', '.join(missing)}")
    claims = _keys(incoming, keys).groupBy(*keys).agg(F.count("*").alias(CLAIMS))
    if strict:
        refused = F.when(F.col(CLAIMS) > 1, _refuse(keys).cast("bigint"))
        claims = claims.withColumn(CLAIMS, refused.otherwise(F.col(CLAIMS)))
    met = existing.join(claims, list(keys), "left")
    several = F.when(F.col(CLAIMS) > 1, _refuse(keys).cast("boolean"))
    kept = met.where(several.otherwise(F.col(CLAIMS).isNull())).select(*existing.columns)
    return kept.unionByName(incoming, allowMissingColumns=True)


def _keys(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    # Not na.drop, which takes NaN for null: Spark joins NaN with NaN.
    return incoming.select(*keys).where(reduce(and_, (F.col(k).isNotNull() for k in keys)))


def _refuse(keys: Sequence[str]):
    # Binary keys have no JSON form.
    named = F.concat_ws(", ", *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys))
    return F.raise_error(F.concat(F.lit("several incoming rows for key "), named))

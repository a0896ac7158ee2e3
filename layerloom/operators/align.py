"""Union of batches whose columns differ."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from layerloom.functions.casts import conform


def union_aligned(batches: Iterable[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Union all by column name; a column a batch lacks is null there, duplicates stay.

    With ``schema`` every batch is first cast to the declared types. Without it, batches whose
    types disagree (a number one year, text the next) fail under ANSI rules.
    """
    if schema is not None:
        batches = [conform(b, schema, keep_extra=True) for b in batches]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)

"""A left join that stays even when one key of the right side holds a large part of its rows.

Adaptive execution splits a large join partition on the left side of a left, semi or anti join and
on both sides of an inner one. What it cannot split is the right side of a left join; that is what
``spread_left_join`` is for. The numbers of rows are exact counts that stay in Spark as a frame of
the plan: no job runs while the plan is built, nothing is collected, and any number of keys may be
hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
SPLITS = "_splits"
PLACE = "_place"

# A key needs no splitting below this many rows: one task handles them with ease.
ROWS_PER_SPLIT = 1_000_000


def split_counts(df: DataFrame, key: str, rows_per_split: int = ROWS_PER_SPLIT) -> DataFrame:
    """Keys with more than ``rows_per_split`` rows and the number of their splits. Null is no key."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    splits = F.ceil(F.col("_n") / rows_per_split).cast("int")
    return counted.where(F.col("_n") > rows_per_split).select(key, splits.alias(SPLITS))


def spread_left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Left outer join on one key; the rows of a hot key of ``right`` go to several tasks.

    A right row carries one salt, taken from all its columns and its place in the input, so equal
    copies and rows of one input task are spread too. A left row is repeated once per split of its
    key. A repeat without a partner is dropped only if its key is hot: such a key has its partners
    under other salts, since counts and rows come from the same frame. ``right`` should be a scan
    or a staged table, whose rows have the same places when a task runs again.
    """
    placed = right.where(F.col(right_key).isNotNull()).withColumn(PLACE, F.monotonically_increasing_id())
    hot = split_counts(right, right_key, rows_per_split)
    salt = F.pmod(F.xxhash64(*right.columns, PLACE), F.coalesce(F.col(SPLITS), F.lit(1)))
    salted = placed.join(hot, right_key, "left").withColumn(SALT, salt.cast("int"))
    b = salted.select(*right.columns, SALT)
    splits = F.coalesce(F.col(SPLITS), F.lit(1))
    each = F.explode(F.sequence(F.lit(0), splits - 1)).alias("_left_salt")
    known = left.join(hot.withColumnRenamed(right_key, left_key), left_key, "left")
    a = known.select(*left.columns, splits.alias(SPLITS), each)
    joined = a.join(b, (a[left_key] == b[right_key]) & (a["_left_salt"] == b[SALT]), "left")
    empty_handed = (F.col(SPLITS) > 1) & F.col(right_key).isNull()
    return joined.where(~empty_handed).drop("_left_salt", SALT, SPLITS)

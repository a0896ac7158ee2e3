"""Gold: metrics per owner with the owner's attributes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.config import Config
from layerloom.functions.casts import tolerant_int
from layerloom.functions.stamps import stamp_day
from layerloom.operators import skew
from layerloom.operators.metrics import OWNER, owner_metrics
from layerloom.plans.silver import read_table, upsert_table
from layerloom.sources import tables


def user_attributes(users: DataFrame) -> DataFrame:
    return users.select(
        F.col("Id").alias("UserId"),
        "DisplayName",
        tolerant_int(F.col("Reputation")).alias("Reputation"),
        "Location", "Views", "UpVotes", "DownVotes",
    )


def with_users(metrics: DataFrame, users: DataFrame, spread: bool = False) -> DataFrame:
    """Add user attributes; owners without a user row keep nulls, repeated users repeat the row.

    No broadcast is forced; Spark broadcasts the users when their size is below its threshold. An
    ``Id`` is unique in a history table; ``spread`` is for users where one may hold very many rows.
    """
    attributes = user_attributes(users)
    if spread:
        joined = skew.spread_left_join(metrics, attributes, OWNER, "UserId")
    else:
        joined = metrics.join(attributes, F.col(OWNER) == F.col("UserId"), "left")
    return joined.drop("UserId")


def post_counts_by_user(posts: DataFrame, users: DataFrame, spread: bool = False) -> DataFrame:
    """Aggregate first, join second: the join sees one row per owner instead of every post."""
    return with_users(owner_metrics(posts), users, spread)


def build_gold(spark: SparkSession, cfg: Config, on: date | None = None) -> DataFrame:
    tables.require(spark, cfg.posts_table, cfg.users_table)
    gold = post_counts_by_user(read_table(spark, cfg.posts_table), read_table(spark, cfg.users_table))
    return upsert_table(spark, cfg, cfg.gold_table, stamp_day(gold, on), [OWNER])

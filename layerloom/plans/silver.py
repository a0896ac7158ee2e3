"""Silver: history tables kept by upsert or rebuilt."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from layerloom.config import Config
from layerloom.functions.stamps import stamp_time
from layerloom.operators.align import union_aligned
from layerloom.operators.upsert import merge_into, upsert
from layerloom.schemas import POST_COLUMNS, POSTS, USERS
from layerloom.sources import tables


def users_batch(
    batches: Sequence[DataFrame], at: datetime | None = None, schema: T.StructType = USERS
) -> DataFrame:
    return stamp_time(union_aligned(batches, schema), at)


def posts_batch(batches: Sequence[DataFrame], at: datetime | None = None) -> DataFrame:
    """All columns of every year, the wide text included."""
    return stamp_time(union_aligned(batches, POSTS), at)


def posts_batch_light(batches: Sequence[DataFrame], at: datetime | None = None) -> DataFrame:
    """Only the columns analysis needs; the wide text is never read from the files."""
    return stamp_time(union_aligned([b.select(*POST_COLUMNS) for b in batches], POSTS), at)


def upsert_table(
    spark: SparkSession, cfg: Config, name: str, incoming: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """Create ``name`` from the batch, or replace and add rows by key."""
    return _write_keyed(spark, cfg, name, incoming, keys, upsert)


def merge_table(
    spark: SparkSession, cfg: Config, name: str, incoming: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """``upsert_table`` that refuses a batch with several rows for one existing row.

    A refused batch leaves the table alone; it never turns into a create.
    """
    return _write_keyed(spark, cfg, name, incoming, keys, merge_into)


def _write_keyed(spark, cfg, name, incoming, keys, combine) -> DataFrame:
    tables.create_namespace(spark, name.rpartition(".")[0], cfg.tables_root)
    key = keys[0] if len(keys) == 1 else tuple(keys)
    if not tables.exists(spark, name):
        tables.rebuild(incoming, name, cfg.tables_root, key, _width(cfg, incoming, key))
        return read_table(spark, name)
    since, own = tables.version(spark, name), tables.ranges_of(spark, name)
    if cfg.range_width is not None and own is not None and own[1] != cfg.range_width:
        raise ValueError(f"{name} is cut by {own[1]} values of {own[0]}, not by {cfg.range_width}")
    # The batch feeds both the anti-join and the union, so it is computed once and read twice.
    with tables.staged(incoming, cfg.staging_root) as batch:
        if own is not None and _same(tables.key_names(own[0]), keys):
            tables.upsert_ranges(batch, name, cfg.tables_root, combine, since)
        else:
            # In one piece, or cut by another key: read whole. The first write under settings that
            # ask for ranges cuts a table that has none.
            width = _width(cfg, spark.table(name), key) if own is None else None
            merged = combine(read_table(spark, name), batch, keys)
            tables.publish(merged, name, cfg.tables_root, since=since, key=key, width=width)
    return read_table(spark, name)


def _same(names: Sequence[str], others: Sequence[str]) -> bool:
    return {n.lower() for n in names} == {n.lower() for n in others}


def _width(cfg: Config, first: DataFrame, key: tables.Key) -> int | None:
    if cfg.range_width is None and cfg.range_rows is not None:
        return tables.width_for(first, key, cfg.range_rows)
    return cfg.range_width


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A history table without the column that only says where its rows lie."""
    return spark.table(name).drop(tables.RANGE)


def build_users(
    spark: SparkSession, cfg: Config, batches: Sequence[DataFrame], at: datetime | None = None
) -> DataFrame:
    return upsert_table(spark, cfg, cfg.users_table, users_batch(batches, at), ["Id"])


def build_posts(
    spark: SparkSession, cfg: Config, batches: Sequence[DataFrame], at: datetime | None = None
) -> DataFrame:
    return merge_table(spark, cfg, cfg.posts_table, posts_batch(batches, at), ["Id"])


def rebuild_posts_light(
    spark: SparkSession, cfg: Config, batches: Sequence[DataFrame], at: datetime | None = None
) -> DataFrame:
    tables.create_namespace(spark, cfg.silver, cfg.tables_root)
    posts, width = posts_batch_light(batches, at), cfg.range_width
    if not tables.exists(spark, cfg.posts_table):
        width = _width(cfg, posts, "Id")
    tables.rebuild(posts, cfg.posts_table, cfg.tables_root, "Id", width)
    return read_table(spark, cfg.posts_table)


def register(
    spark: SparkSession, cfg: Config, name: str, batches: Sequence[DataFrame]
) -> DataFrame:
    """Put Bronze batches into the catalog as they are: all columns, no stamp, no overwrite."""
    tables.create_namespace(spark, name.rpartition(".")[0], cfg.tables_root)
    tables.create(union_aligned(batches), name, cfg.tables_root)
    return spark.table(name)

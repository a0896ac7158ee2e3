"""Job parameters and session set-up."""

from __future__ import annotations

import tempfile
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Config:
    """Everything a run needs to know.

    ``root`` is a folder every executor can reach. A limit of ``None`` means no cap and ``0``
    means no rows. ``range_width`` cuts new history tables into partitions of so many keys, so that
    an upsert leaves alone the ranges its batch has no keys in; ``range_rows`` takes the width at which
    a range of the first batch has about so many rows instead. The width counts whole numbers, days of
    dates, seconds of timestamps, and for other keys and several columns parts of 2^31 hash values. It
    stays with the table. With neither a table is in one piece, until an upsert under settings with one.
    """

    root: str
    years: tuple[int, ...] = (2020, 2021)
    limit_posts: int | None = None
    limit_users: int | None = None
    silver: str = "silver"
    gold: str = "gold"
    range_width: int | None = None
    range_rows: int | None = None
    session: Mapping[str, str] = field(default_factory=dict)

    @property
    def posts_table(self) -> str:
        return f"{self.silver}.posts_hist"

    @property
    def users_table(self) -> str:
        return f"{self.silver}.users_hist"

    @property
    def gold_table(self) -> str:
        return f"{self.gold}.post_counts_by_user"

    def bronze(self, entity: str) -> str:
        return f"{self.root}/bronze/{entity}"

    @property
    def tables_root(self) -> str:
        return f"{self.root}/tables"

    @property
    def staging_root(self) -> str:
        return f"{self.root}/staging"

    @classmethod
    def from_env(cls, env: Mapping[str, str]) -> Config:
        """Read the run's parameters from environment-style settings."""
        years = tuple(int(y) for y in env.get("BRONZE_YEAR", "2020,2021").split(","))
        shared = env.get("BRONZE_LIMIT")
        return cls(
            root=env["WAREHOUSE"].rstrip("/"),
            years=years,
            limit_posts=_limit(env.get("BRONZE_LIMIT_POSTS", shared)),
            limit_users=_limit(env.get("BRONZE_LIMIT_USERS", shared)),
            range_width=_limit(env.get("RANGE_WIDTH")),
            range_rows=_limit(env.get("RANGE_ROWS")),
        )


def _limit(text: str | None) -> int | None:
    return int(text) if text else None


# What every session gets unless the caller says otherwise. Shuffle sizes are left to adaptive
# execution: it starts from many small partitions and merges them up to the advisory size.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # When the small side of a shuffled join turns out to fit, hash it instead of sorting both.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.parquet.compression.codec": "snappy",
    # Do not record the Python call site of every column expression while plans are built.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str, cfg: Config | None = None, master: str | None = None) -> SparkSession:
    """A session with UTC clocks; catalog, storage and sizing come from ``cfg.session``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_DEFAULTS, **(cfg.session if cfg else {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for a local session without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="layerloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made

"""Helpers of the operators in this folder."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.config import shared_folder
from layerloom.sources import tables

# White space of the word rules: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]+"


@cache
def _ship(spark: SparkSession, application: str) -> None:
    package = Path(__file__).resolve().parents[1]
    made = f"{tempfile.mkdtemp(prefix='layerloom-')}/{package.name}"
    shutil.make_archive(made, "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(f"{made}.zip")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application; Spark itself distributes the file."""
    _ship(spark, spark.sparkContext.applicationId)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows that go to a Python worker at once while a table is staged: texts may be long.
ARROW_ROWS = 1000


def stage(df: DataFrame, arrow_rows: int = ARROW_ROWS) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: lineage is cut, a lost executor
    costs a re-read, and the planner knows the size. Arrow batches are kept small meanwhile."""
    conf, rows = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(rows)
    conf.set(rows, str(arrow_rows))
    try:
        return tables.stage(df, f"{shared_folder(df.sparkSession)}/llm")
    finally:
        conf.set(rows, before)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries that are made and run inside give back the disk of their shuffles when they end, not
    when the driver happens to collect its garbage. For jobs whose result is written or collected."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bit_map(hashes: DataFrame, longs_bits: int) -> DataFrame:
    """One row, ``map``: 2**``longs_bits`` longs with the bits of all ``hashes`` (one column of 64-bit
    values). Its size does not depend on the number of hashes."""
    hashed = F.col(hashes.columns[0])
    set_bits = hashes.select(_slot(hashed, longs_bits).alias("slot"), F.call_function("shiftleft", F.lit(1).cast("long"), _bit(hashed)).alias("bits"))
    every = hashes.sparkSession.range(1 << longs_bits).select(F.col("id").cast("int").alias("slot"), F.lit(0).cast("long").alias("bits"))
    slots = set_bits.unionAll(every).groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("slot", "bits")))
    return slots.agg(F.transform(ordered, lambda s: s["bits"]).alias("map"))


def in_bit_map(made: DataFrame, hashed: Column, longs_bits: int) -> Column:
    """Whether the bit of ``hashed`` is set in ``made`` by ``bit_map``: always for its hashes, by chance
    for others. Null for a null."""
    held = F.get(made.scalar(), _slot(hashed, longs_bits))
    return F.call_function("shiftrightunsigned", held, _bit(hashed)).bitwiseAND(F.lit(1)) == 1


def _slot(hashed: Column, longs_bits: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - longs_bits).cast("int")


def _bit(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(63)).cast("int")

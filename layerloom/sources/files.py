"""Parquet files in and out, one folder per entity and year."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.casts import conform


def read_entity(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Scan one entity; with ``columns`` only those reach the Parquet reader."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path)
    return df.select(*columns) if columns else df


def yearly_path(template: str, year: int) -> str:
    """Fill a source template such as ``…/posts/{year}.parquet``."""
    return template.format(year=year)


def read_years(
    spark: SparkSession,
    template: str,
    years: Iterable[int],
    schema: T.StructType | None = None,
    keep_extra: bool = False,
) -> list[DataFrame]:
    """One frame per year. Each year is read with its own file schema, because a single read over
    years with different columns would take the schema of whichever file came first."""
    frames = [read_entity(spark, yearly_path(template, y)) for y in years]
    if schema is None:
        return frames
    return [conform(f, schema, keep_extra) for f in frames]


def read_span(
    spark: SparkSession, root: str, years: Iterable[int], schema: T.StructType
) -> DataFrame:
    """The given years of an entity that was written with one schema, as one scan.

    Nothing is inferred, so no job runs; folders of other years are not opened.
    """
    whole = T.StructType([*schema.fields, T.StructField("year", T.IntegerType())])
    every = read_entity(spark, root, schema=whole)
    return every.where(F.col("year").isin([*years])).drop("year")


def write_year(df: DataFrame, root: str, year: int) -> str:
    """Replace one year of an entity; other years stay as they are."""
    target = f"{root}/year={year}"
    df.write.mode("overwrite").option("compression", "snappy").parquet(target)
    return target


def write_years(df: DataFrame, root: str, years: Sequence[int], year_column: str = "year") -> str:
    """Replace exactly the named years of an entity in one pass over ``df``.

    Rows of other years are left out and other years stay as they are; a named year without rows
    becomes empty. The rebalance hint lets adaptive execution split a year that holds most of the
    rows over many writers and put small years together, so files come out evenly sized.
    """
    if not years:
        return root
    year = F.col(year_column)
    # Counted while the rows pass by, so that no second pass has to find the empty years.
    seen = Observation()
    counts = [F.count_if(year == y).alias(str(y)) for y in years]
    named = df.where(year.isin([*years])).observe(seen, *counts)
    (
        named.hint("rebalance", year)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(year_column)
        .parquet(root)
    )
    for y in years:
        if not seen.get[str(y)]:
            write_year(df.where(F.lit(False)).drop(year_column), root, y)
    return root


FOUND = "file_path string, n_bytes long, n_rows long, error string"


# A column no file has: rows are counted without a look at what the files hold.
_NOTHING = T.StructType([T.StructField("_nothing", T.IntegerType())])


def rows_per_file(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Listing of all Parquet files under ``paths``: size and rows, empty files included.

    Sizes come from a listing of the storage, rows from the files' footers, which tasks read. A path
    that is not there is listed with an error, one without files gives no row, and a file whose footer
    cannot be read has its error in its own row. Files that gave no row are looked at one by one.
    """
    parts, found = [], []
    for path in paths:
        place = _hadoop_path(spark, path)
        if place.getFileSystem(_hadoop_conf(spark)).exists(place):
            found.append(path)
        else:
            parts.append(spark.createDataFrame([(path, None, None, "missing")], FOUND))
    if found:
        parts.append(_listed(spark, found))
    return reduce(DataFrame.unionAll, parts)


def _listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    def scan(kind: str):
        return spark.read.format(kind).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")

    name = F.col("_metadata.file_path").alias("file_path")
    listed = scan("binaryFile").load([*paths]).select(name, F.col("length").alias("n_bytes"))
    whole = scan("parquet").option("ignoreCorruptFiles", "true").schema(_NOTHING).load([*paths])
    counted = whole.groupBy(name).agg(F.count("*").alias("n_rows"))
    silent = [r["file_path"] for r in listed.join(counted, "file_path", "left_anti").select("file_path").collect()]
    looked = spark.createDataFrame([(f, _footer_error(spark, f)) for f in silent], "file_path string, error string")
    both = listed.join(counted, "file_path", "left").join(looked, "file_path", "left")
    rows = F.coalesce("n_rows", F.when(F.col("error").isNull(), 0))
    return both.select("file_path", "n_bytes", rows.alias("n_rows"), "error")


def _hadoop_conf(spark: SparkSession):
    return spark.sparkContext._jsc.hadoopConfiguration()


def _hadoop_path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _footer_error(spark: SparkSession, path: str) -> str | None:
    """Why the footer of a file cannot be read; ``None`` for a readable one."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(path))
    try:
        spark.sparkContext._jvm.org.apache.parquet.hadoop.ParquetFileReader.readFooter(_hadoop_conf(spark), place)
    except Py4JJavaError as e:
        return e.java_exception.getMessage().splitlines()[0]
    return None

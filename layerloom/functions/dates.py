"""Date parsing and year filters."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.casts import tolerant_timestamp


def parse_dates(df: DataFrame, column: str = "CreationDate") -> DataFrame:
    """Dates without zone; a column that holds them already stays as it is, open to pushdown."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return df
    return df.withColumn(column, tolerant_timestamp(F.col(column)))


def in_years(column: Column, first: int, last: int | None = None) -> Column:
    """True inside the years ``first`` to ``last``.

    A half-open range instead of ``year(column) = y``: the range reaches the Parquet scan and
    lets it skip row groups, the function call does not.
    """
    after = first + 1 if last is None else last + 1
    return (column >= _new_year(first)) & (column < _new_year(after))


def in_any_year(column: Column, years: Iterable[int]) -> Column:
    """True inside any of the named years: a half-open range for each run of years without a gap."""
    runs: list[list[int]] = []
    for year in sorted(set(years)):
        if runs and runs[-1][1] == year - 1:
            runs[-1][1] = year
        else:
            runs.append([year, year])
    return reduce(or_, (in_years(column, *run) for run in runs), F.lit(False))


def _new_year(year: int) -> Column:
    return F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")


def filter_year(df: DataFrame, year: int, column: str = "CreationDate") -> DataFrame:
    return df.where(in_years(F.col(column), year))


def drop_null_dates(df: DataFrame, column: str = "CreationDate") -> DataFrame:
    return df.na.drop(subset=[column])


def with_year(df: DataFrame, column: str = "CreationDate") -> DataFrame:
    """Add the ``year`` column that Bronze is partitioned by."""
    return df.withColumn("year", F.year(column))

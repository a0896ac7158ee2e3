"""Bronze: raw rows per entity and year."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.functions.dates import drop_null_dates, filter_year, in_any_year, parse_dates, with_year
from layerloom.operators.limits import first_rows
from layerloom.sources.files import write_year, write_years


def users_of_year(
    users: DataFrame,
    year: int,
    limit: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Users created in ``year``: dates parsed, unreadable ones dropped, capped by lowest Id.

    ``columns`` narrows the scan, as for years that arrive with fewer columns.
    """
    picked = users.select(*columns) if columns else users
    dated = drop_null_dates(parse_dates(picked))
    return first_rows(filter_year(dated, year), limit, "Id")


def posts_of_year(posts: DataFrame, limit: int | None = None) -> DataFrame:
    """Posts of a source that already holds a single year; only the cap applies."""
    return first_rows(posts, limit, "Id")


def ingest_users(
    users: DataFrame,
    root: str,
    year: int,
    limit: int | None = None,
    columns: Sequence[str] | None = None,
) -> str:
    return write_year(users_of_year(users, year, limit, columns), root, year)


def ingest_posts(posts: DataFrame, root: str, year: int, limit: int | None = None) -> str:
    return write_year(posts_of_year(posts, limit), root, year)


def ingest_years(df: DataFrame, root: str, years: Iterable[int], limit: int | None = None) -> str:
    """Replace the named years by the rows of a source that spans years, in one pass over it.

    Only those years change: years between them stay as they are, and a named year the source has
    no rows of becomes empty. ``limit`` keeps the rows with the lowest Ids of each year.
    """
    years = sorted(set(years))
    dated = parse_dates(df)
    kept = with_year(dated.where(in_any_year(F.col("CreationDate"), years)))
    return write_years(first_rows(kept, limit, "Id", "year"), root, years)


def ingest_span(
    df: DataFrame, root: str, first: int, last: int, limit: int | None = None
) -> str:
    """``ingest_years`` for all years from ``first`` to ``last``."""
    return ingest_years(df, root, range(first, last + 1), limit)

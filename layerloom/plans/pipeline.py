"""The three layers in order."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from layerloom.config import Config
from layerloom.functions.dates import parse_dates
from layerloom.plans.bronze import ingest_years
from layerloom.plans.gold import build_gold
from layerloom.plans.silver import build_users, read_table, rebuild_posts_light
from layerloom.schemas import POSTS
from layerloom.sources import tables
from layerloom.sources.files import read_span, read_years
from layerloom.sources.markers import Markers, digest, input_digest


def _step(marks: Markers | None, name: str, of: str, do: Callable[[], object], there: bool = True) -> None:
    """Run a step, unless the run has it marked as done on the same input and its result is there."""
    if marks is not None and there and marks.done(name, of):
        return
    do()
    if marks is not None:
        marks.mark(name, of)


def _marks(spark: SparkSession, cfg: Config, run: str | None) -> Markers | None:
    return None if run is None else Markers(spark, f"{cfg.root}/runs/{run}")


def build_layers(
    spark: SparkSession,
    cfg: Config,
    at: datetime | None = None,
    on: date | None = None,
    run: str | None = None,
) -> DataFrame:
    """Silver and Gold from the Bronze years of ``cfg``; each step starts when the one before is
    written. Steps hand over by table. With the name of a ``run`` every finished step leaves a marker,
    and calling the same run again goes on with the first step that has none, or has other input."""
    year_of = "/year={year}"
    posts = read_years(spark, cfg.bronze("posts") + year_of, cfg.years, POSTS)
    users = read_years(spark, cfg.bronze("users") + year_of, cfg.years)
    marks = _marks(spark, cfg, run)
    inputs = [digest(*map(input_digest, frames)) if marks else "" for frames in (posts, users)]
    return _build(spark, cfg, posts, users, at, on, marks, inputs)


def _build(spark, cfg, posts, users, at, on, marks, inputs) -> DataFrame:
    there = lambda name: tables.exists(spark, name)
    of_posts, of_users = (digest(i, at, cfg.years, cfg.range_width) for i in inputs)
    _step(marks, "silver_posts", of_posts, lambda: rebuild_posts_light(spark, cfg, posts, at), there(cfg.posts_table))
    _step(marks, "silver_users", of_users, lambda: build_users(spark, cfg, users, at), there(cfg.users_table))
    of_gold = digest(of_posts, of_users, on)
    _step(marks, "gold", of_gold, lambda: build_gold(spark, cfg, on), there(cfg.gold_table))
    return read_table(spark, cfg.gold_table)


def run_pipeline(
    spark: SparkSession,
    cfg: Config,
    posts: DataFrame,
    users: DataFrame,
    at: datetime | None = None,
    on: date | None = None,
    run: str | None = None,
) -> DataFrame:
    """Bronze, Silver and Gold of the years of ``cfg`` from the raw sources, each read once.

    Years and row caps come from ``cfg``; only the years it names are written. What Bronze holds is
    known here, so its schemas are not inferred again. ``run`` works as in ``build_layers``.
    """
    marks = _marks(spark, cfg, run)
    written, inputs = [], []
    for entity, source, limit in (("posts", posts, cfg.limit_posts), ("users", users, cfg.limit_users)):
        dated = parse_dates(source)
        of = digest(input_digest(source), cfg.years, limit) if marks else ""
        _step(marks, f"bronze_{entity}", of, lambda: ingest_years(dated, cfg.bronze(entity), cfg.years, limit))  # noqa: B023
        written.append(read_span(spark, cfg.bronze(entity), cfg.years, dated.schema))
        inputs.append(of)
    return _build(spark, cfg, *([w] for w in written), at, on, marks, inputs)

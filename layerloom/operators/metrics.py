"""Per-owner measures over posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OWNER = "OwnerUserId"

# Post type codes and the names of the published measures.
QUESTION, ANSWER = 1, 2
TYPE_COUNTS = {"total_preguntas": QUESTION, "total_respuestas": ANSWER}
SUMS = {
    "total_score": "Score",
    "total_views": "ViewCount",
    "total_comments": "CommentCount",
    "total_answers_received": "AnswerCount",
}


def owned(posts: DataFrame) -> DataFrame:
    return posts.where(F.col(OWNER).isNotNull())


def count_filled(column: str) -> Column:
    """Rows in which ``column`` has a value."""
    return F.count(column)


def count_of_type(code: int) -> Column:
    return F.count_if(F.col("PostTypeId") == code)


def total(column: str) -> Column:
    """Sum that skips nulls; null when there is nothing to add up."""
    return F.sum(column)


def total_or_zero(column: str) -> Column:
    """Sum in which a null counts as 0, so a group of nulls gives 0."""
    return F.sum(F.coalesce(F.col(column).cast("int"), F.lit(0)))


def mean_rounded(column: str, places: int = 2) -> Column:
    return F.round(F.avg(column), places)


def owner_metrics(posts: DataFrame) -> DataFrame:
    """One row per owner, null owners left out.

    Every measure is combined inside the map tasks first, so an owner with a third of all posts
    sends one row per task through the shuffle like any other.
    """
    measures = [count_filled("Id").alias("total_posts")]
    measures += [count_of_type(code).alias(name) for name, code in TYPE_COUNTS.items()]
    measures += [mean_rounded("Score").alias("score_promedio")]
    measures += [total(column).alias(name) for name, column in SUMS.items()]
    return owned(posts).groupBy(OWNER).agg(*measures).select(OWNER, *METRIC_ORDER)


# Order of the measures in the published table.
METRIC_ORDER = (
    "total_posts", "total_preguntas", "total_respuestas", "total_score",
    "score_promedio", "total_views", "total_comments", "total_answers_received",
)

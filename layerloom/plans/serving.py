"""Serving reports over Gold and Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.operators import skew
from layerloom.operators.limits import top_rows
from layerloom.operators.metrics import ANSWER, OWNER, QUESTION, owned, total_or_zero

# Measures of the report and the columns they add up.
SERVED_SUMS = {"total_score": "Score", "total_views": "ViewCount", "total_comments": "CommentCount"}
SERVED_TYPES = {"total_preguntas": QUESTION, "total_respuestas": ANSWER}


def _of_type(code: int):
    hit = F.col("PostTypeId").cast("int") == code
    return F.sum(F.when(hit, 1).otherwise(0))


def served_measures() -> dict:
    """The report's measures; unlike Gold's, a null adds 0 and rows are counted without a column."""
    counts = {"total_posts": F.count("*")}
    counts |= {name: _of_type(code) for name, code in SERVED_TYPES.items()}
    return counts | {name: total_or_zero(column) for name, column in SERVED_SUMS.items()}


def gold_from_silver(posts: DataFrame, users: DataFrame, spread: bool = False) -> DataFrame:
    """Metrics by owner, display name and location, straight from posts left-joined to users.

    The report is defined as join first, group second. All its measures are sums, so the same
    numbers come from grouping both sides first and multiplying: posts shrink to one row per owner
    and users to one row per distinct (Id, name, location) with the number of its copies, before
    anything is joined. A user row that occurs twice still counts its posts twice. ``spread`` is
    for users where one ``Id`` may hold very many different rows.
    """
    measures = served_measures()
    per_owner = owned(posts).groupBy(OWNER).agg(*(m.alias(n) for n, m in measures.items()))
    people = users.groupBy(F.col("Id").alias("UserId"), "DisplayName", "Location").agg(
        F.count("*").alias("_copies")
    )
    if spread:
        joined = skew.spread_left_join(per_owner, people, OWNER, "UserId")
    else:
        joined = per_owner.join(people, F.col(OWNER) == F.col("UserId"), "left")
    copies = F.coalesce("_copies", F.lit(1))
    return joined.select(
        OWNER, *((F.col(n) * copies).alias(n) for n in measures), "DisplayName", "Location"
    )


def top_owners(posts: DataFrame, users: DataFrame, k: int = 20) -> DataFrame:
    return top_rows(
        gold_from_silver(posts, users), "total_posts", k, OWNER, "DisplayName", "Location"
    )

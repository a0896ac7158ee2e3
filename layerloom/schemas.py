"""Declared schemas of the entities."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and order of the stored tables.
POST_COLUMNS = (
    "Id", "PostTypeId", "AcceptedAnswerId", "CreationDate",
    "Score", "ViewCount", "OwnerUserId", "LastActivityDate",
    "Title", "Tags", "AnswerCount", "CommentCount",
    "FavoriteCount", "ContentLicense", "ParentId",
)
USER_COLUMNS_NARROW = ("Id", "CreationDate", "Reputation")
LOAD_STAMP = "fecha_cargue"

_TYPES: dict[str, T.DataType] = {
    **dict.fromkeys(("Id", "AcceptedAnswerId", "ParentId", "OwnerUserId"), T.LongType()),
    **dict.fromkeys(
        ("PostTypeId", "Score", "ViewCount", "AnswerCount", "CommentCount", "FavoriteCount"),
        T.IntegerType(),
    ),
    **dict.fromkeys(("Views", "UpVotes", "DownVotes"), T.IntegerType()),
    **dict.fromkeys(("CreationDate", "LastActivityDate"), T.TimestampNTZType()),
    **dict.fromkeys(("Title", "Tags", "ContentLicense"), T.StringType()),
    **dict.fromkeys(("Reputation", "DisplayName", "Location"), T.StringType()),
}


def _struct(names: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[n], n != "Id") for n in names])


POSTS = _struct(POST_COLUMNS)
USERS = _struct(
    ("Id", "CreationDate", "Reputation", "DisplayName", "Location", "Views", "UpVotes", "DownVotes")
)
USERS_NARROW = _struct(USER_COLUMNS_NARROW)

"""Posts and users made from the driver's test tables, for the entry point and the tests only.

Every function reads its whole table. ``*_SQL`` is the same mapping as text for the oracle; the two
are written separately on purpose. Nulls, unreadable text, owners without a user row and one owner
with a fifth of all posts come out of real columns, no row is filtered away.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerloom.schemas import POST_COLUMNS
from layerloom.sources.files import read_entity

COMMUNITY = -1  # owner of every fifth post; has no user row


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_entity(spark, f"{sf_dir}/{name}.parquet")


def _whole(c) -> F.Column:
    return F.floor(c).cast("int")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as posts: status is the post type, priority decides owner and missing scores."""
    status, priority, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    question, answer = status == "O", status == "F"
    owner = (
        F.when(priority == "1-URGENT", COMMUNITY)
        .when(priority == "2-HIGH", -2 - F.col("o_custkey"))
        .when(priority != "5-LOW", F.col("o_custkey"))
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Id"),
        F.when(question, 1).when(answer, 2).otherwise(4).alias("PostTypeId"),
        F.when(question, F.col("o_orderkey") + 1).alias("AcceptedAnswerId"),
        F.col("o_orderdate").alias("CreationDate"),
        F.when(priority != "4-NOT SPECIFIED", _whole(price / 1000) - 50).alias("Score"),
        F.when(question, _whole(price / 100)).alias("ViewCount"),
        owner.cast("bigint").alias("OwnerUserId"),
        (F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")).alias("LastActivityDate"),
        F.when(question, F.concat(F.lit("Post "), F.col("o_orderkey").cast("string"))).alias("Title"),
        F.when(question, F.concat(F.lit("<"), F.lower(priority), F.lit(">"))).alias("Tags"),
        F.when(question, _whole(price / 100000)).alias("AnswerCount"),
        _whole(price / 20000).alias("CommentCount"),
        F.lit(None).cast("int").alias("FavoriteCount"),
        F.lit("CC BY-SA 4.0").alias("ContentLicense"),
        F.when(answer, F.col("o_orderkey") - 1).alias("ParentId"),
    )


POSTS_SQL = """
SELECT o_orderkey AS Id,
       CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 2 ELSE 4 END AS PostTypeId,
       CASE WHEN o_orderstatus = 'O' THEN o_orderkey + 1 END AS AcceptedAnswerId,
       o_orderdate AS CreationDate,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
            THEN CAST(floor(o_totalprice / 1000) AS INT) - 50 END AS Score,
       CASE WHEN o_orderstatus = 'O' THEN CAST(floor(o_totalprice / 100) AS INT) END AS ViewCount,
       CAST(CASE o_orderpriority WHEN '1-URGENT' THEN -1 WHEN '2-HIGH' THEN -2 - o_custkey
            WHEN '5-LOW' THEN NULL ELSE o_custkey END AS BIGINT) AS OwnerUserId,
       o_orderdate + INTERVAL 30 DAY AS LastActivityDate,
       CASE WHEN o_orderstatus = 'O' THEN concat('Post ', CAST(o_orderkey AS VARCHAR)) END AS Title,
       CASE WHEN o_orderstatus = 'O' THEN concat('<', lower(o_orderpriority), '>') END AS Tags,
       CASE WHEN o_orderstatus = 'O' THEN CAST(floor(o_totalprice / 100000) AS INT) END AS AnswerCount,
       CAST(floor(o_totalprice / 20000) AS INT) AS CommentCount,
       CAST(NULL AS INT) AS FavoriteCount,
       'CC BY-SA 4.0' AS ContentLicense,
       CASE WHEN o_orderstatus = 'F' THEN o_orderkey - 1 END AS ParentId
FROM orders
"""


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users; dates and reputations are text, some of it unreadable."""
    balance, nation = F.col("c_acctbal"), F.col("c_nationkey")
    year = (1995 + _whole(nation / 4)).cast("string")
    segment = F.col("c_mktsegment")
    reputation = (
        F.when(balance < 0, "n/a")
        .when(segment == "FURNITURE", balance.cast("string"))
        .otherwise(_whole(balance).cast("string"))
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Id"),
        F.when((segment == "MACHINERY") & (balance < 1000), "bad-date")
        .otherwise(F.concat(year, F.lit("-06-15 08:30:00")))
        .alias("CreationDate"),
        reputation.alias("Reputation"),
        F.col("c_name").alias("DisplayName"),
        F.when(nation != 0, segment).alias("Location"),
        _whole(balance / 10).alias("Views"),
        nation.alias("UpVotes"),
        _whole(balance / 1000).alias("DownVotes"),
    )


USERS_RAW_SQL = """
SELECT c_custkey AS Id,
       CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal < 1000 THEN 'bad-date'
            ELSE concat(CAST(1995 + CAST(floor(c_nationkey / 4.0) AS INT) AS VARCHAR),
                        '-06-15 08:30:00') END AS CreationDate,
       CASE WHEN c_acctbal < 0 THEN 'n/a'
            WHEN c_mktsegment = 'FURNITURE' THEN CAST(c_acctbal AS VARCHAR)
            ELSE CAST(CAST(floor(c_acctbal) AS INT) AS VARCHAR) END AS Reputation,
       c_name AS DisplayName,
       CASE WHEN c_nationkey <> 0 THEN c_mktsegment END AS Location,
       CAST(floor(c_acctbal / 10) AS INT) AS Views,
       c_nationkey AS UpVotes,
       CAST(floor(c_acctbal / 1000) AS INT) AS DownVotes
FROM customer
"""

# Users with parsed dates, as they are after Bronze.
USERS_SQL = f"""
SELECT Id, TRY_CAST(CreationDate AS TIMESTAMP) AS CreationDate, Reputation, DisplayName, Location,
       Views, UpVotes, DownVotes
FROM ({USERS_RAW_SQL})
"""


def users_batch(spark: SparkSession, sf_dir: str, about: bool = False) -> DataFrame:
    """Suppliers as a later, narrow batch of users; about three in four Ids are known already.

    ``about`` adds a column the earlier users do not have.
    """
    return table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") * 20).alias("Id"),
        F.concat((2000 + F.col("s_nationkey")).cast("string"), F.lit("-01-02 03:04:05")).alias(
            "CreationDate"
        ),
        _whole("s_acctbal").cast("string").alias("Reputation"),
        *([F.col("s_name").alias("AboutMe")] if about else []),
    )


USERS_BATCH_SQL = """
SELECT s_suppkey * 20 AS Id,
       CAST(concat(CAST(2000 + s_nationkey AS VARCHAR), '-01-02 03:04:05') AS TIMESTAMP) AS CreationDate,
       CAST(CAST(floor(s_acctbal) AS INT) AS VARCHAR) AS Reputation,
       s_name AS AboutMe
FROM supplier
"""


def posts_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a later batch of posts; part of the Ids are known, part are new."""
    kind = F.col("event_type")
    value = _whole("value")
    made = {
        "Id": F.col("event_id") * 2,
        "PostTypeId": F.when(kind == "view", 1).when(kind == "click", 2).otherwise(4),
        "CreationDate": F.col("ts"),
        "Score": value,
        "OwnerUserId": F.col("user_id"),
        "Title": F.col("props"),
        "Tags": kind,
        "CommentCount": F.when(kind != "error", value),
    }
    return table(spark, sf_dir, "events").select(
        *(
            made.get(name, F.lit(None).cast(kind_of)).alias(name)
            for name, kind_of in _POST_TYPES.items()
        )
    )


_POST_TYPES = dict(
    zip(
        POST_COLUMNS,
        "bigint int bigint timestamp_ntz int int bigint timestamp_ntz string string int int int "
        "string bigint".split(),
    )
)

POSTS_BATCH_SQL = """
SELECT event_id * 2 AS Id,
       CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 4 END AS PostTypeId,
       CAST(NULL AS BIGINT) AS AcceptedAnswerId,
       ts AS CreationDate,
       CAST(floor(value) AS INT) AS Score,
       CAST(NULL AS INT) AS ViewCount,
       user_id AS OwnerUserId,
       CAST(NULL AS TIMESTAMP) AS LastActivityDate,
       props AS Title,
       event_type AS Tags,
       CAST(NULL AS INT) AS AnswerCount,
       CASE WHEN event_type <> 'error' THEN CAST(floor(value) AS INT) END AS CommentCount,
       CAST(NULL AS INT) AS FavoriteCount,
       CAST(NULL AS VARCHAR) AS ContentLicense,
       CAST(NULL AS BIGINT) AS ParentId
FROM events
"""


def posts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as full posts: the long text is the body, which the light scan leaves out."""
    doc = F.col("doc_id")
    made = {
        "Id": doc,
        "PostTypeId": F.when(F.col("lang") == "en", 1).otherwise(2),
        "ViewCount": F.col("n_chars").cast("int"),
        "Title": F.concat(F.lit("Document "), doc.cast("string")),
        "Tags": F.concat(F.lit("<"), F.col("source"), F.lit(">")),
    }
    return table(spark, sf_dir, "documents").select(
        *(made.get(n, F.lit(None).cast(t)).alias(n) for n, t in _POST_TYPES.items()),
        F.col("text").alias("Body"),
        F.col("lang").alias("OwnerDisplayName"),
        F.lit(None).cast("string").alias("LastEditorDisplayName"),
    )


POSTS_WIDE_SQL = """
SELECT doc_id AS Id,
       CASE WHEN lang = 'en' THEN 1 ELSE 2 END AS PostTypeId,
       CAST(NULL AS BIGINT) AS AcceptedAnswerId,
       CAST(NULL AS TIMESTAMP) AS CreationDate,
       CAST(NULL AS INT) AS Score,
       CAST(n_chars AS INT) AS ViewCount,
       CAST(NULL AS BIGINT) AS OwnerUserId,
       CAST(NULL AS TIMESTAMP) AS LastActivityDate,
       concat('Document ', CAST(doc_id AS VARCHAR)) AS Title,
       concat('<', source, '>') AS Tags,
       CAST(NULL AS INT) AS AnswerCount,
       CAST(NULL AS INT) AS CommentCount,
       CAST(NULL AS INT) AS FavoriteCount,
       CAST(NULL AS VARCHAR) AS ContentLicense,
       CAST(NULL AS BIGINT) AS ParentId,
       text AS Body,
       lang AS OwnerDisplayName,
       CAST(NULL AS VARCHAR) AS LastEditorDisplayName
FROM documents
"""

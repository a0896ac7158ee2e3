"""Entry point, registered queries and their oracle SQL.

Inputs are the mapped test tables of ``fixtures.py``. Stamps are fixed so results repeat.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timezone
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import fixtures as fx  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from layerloom.config import SESSION_DEFAULTS, Config, build_session, shared_folder  # noqa: E402
from layerloom.functions.casts import conform, tolerant_int, tolerant_timestamp  # noqa: E402
from layerloom.functions.dates import (  # noqa: E402
    drop_null_dates,
    filter_year,
    in_years,
    parse_dates,
)
from layerloom.functions.stamps import stamp_day, stamp_time  # noqa: E402
from layerloom.operators import metrics as m  # noqa: E402
from layerloom.operators import skew  # noqa: E402
from layerloom.operators.align import union_aligned  # noqa: E402
from layerloom.operators.audit import row_counts, table_report  # noqa: E402
from layerloom.operators.limits import preview  # noqa: E402
from layerloom.operators.upsert import (  # noqa: E402
    anti_unchanged,
    merge_into,
    upsert,
)
from layerloom.plans import bronze, gold, pipeline, serving, silver  # noqa: E402
from layerloom.schemas import POST_COLUMNS, POSTS, USER_COLUMNS_NARROW, USERS  # noqa: E402
from layerloom.sources import files, tables  # noqa: E402

# The operators for training data live in a folder of their own and may be absent.
try:
    import corpus_pipeline  # noqa: E402

    from layerloom.llm import registry as llm  # noqa: E402
except ModuleNotFoundError as gone:
    if gone.name not in ("corpus_pipeline", "layerloom.llm"):
        raise
    corpus_pipeline = llm = None

FIRST_STAMP, NEXT_STAMP = datetime(2023, 1, 1), datetime(2024, 1, 1)
FIRST_DAY, NEXT_DAY = date(2023, 1, 1), date(2024, 1, 1)
YEAR = 1998
# What orders of the test table get after their time, in turn.
_ZONES = ("Z", "+05:00", "-03:30", "", " Europe/Paris")
WIDE_YEARS, NARROW_YEARS = (1995, 1998), (1999, 2001)

GIVEN_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    return gold_post_counts(spark, "/root/testdata/sf0.001")


def _workspace(spark: SparkSession, years: tuple[int, int] = (1995, 2001)) -> Config:
    """Fresh folders in the cluster's shared folder and fresh namespaces for one run."""
    run = f"layerloom_{uuid.uuid4().hex[:12]}"
    return Config(
        root=f"{shared_folder(spark)}/{run}",
        years=tuple(range(years[0], years[1] + 1)),
        silver=f"{run}_silver",
        gold=f"{run}_gold",
    )


def _known_users(spark, sf):
    return stamp_time(parse_dates(fx.users(spark, sf)), FIRST_STAMP)


def _new_users(spark, sf, about=False):
    return stamp_time(parse_dates(fx.users_batch(spark, sf, about)), NEXT_STAMP)


# --- scans ---------------------------------------------------------------------------------------


def scan_posts(spark, sf):
    return fx.posts_wide(spark, sf)


def scan_posts_light(spark, sf):
    return fx.posts_wide(spark, sf).select(*POST_COLUMNS)


def scan_limit(spark, sf):
    """Which rows a preview shows is open: how many they are, and how many of them are posts."""
    posts = fx.posts(spark, sf)
    shown = preview(posts, 20).select("Id")
    known = posts.select("Id", F.lit(True).alias("known"))
    met = shown.join(known, "Id", "left")
    return met.agg(F.count("*").alias("n_rows"), F.count_if("known").alias("n_known"))


def catalog_scan(spark, sf):
    cfg = _workspace(spark)
    tables.create_namespace(spark, cfg.silver, cfg.tables_root)
    tables.create(parse_dates(fx.users(spark, sf)), cfg.users_table, cfg.tables_root)
    tables.require(spark, cfg.users_table)
    return spark.table(cfg.users_table)


# --- dates, Bronze -------------------------------------------------------------------------------


def parse_dates_query(spark, sf):
    return parse_dates(fx.users(spark, sf)).select("Id", "CreationDate")


def filter_year_query(spark, sf):
    return filter_year(fx.posts(spark, sf), YEAR)


def drop_null_dates_query(spark, sf):
    return drop_null_dates(parse_dates(fx.users(spark, sf)))


def ingest_users_year(spark, sf):
    return bronze.users_of_year(fx.users(spark, sf), YEAR, columns=USER_COLUMNS_NARROW)


def ingest_users_capped(spark, sf):
    return bronze.users_of_year(fx.users(spark, sf), YEAR, limit=100)


def ingest_posts_capped(spark, sf):
    return bronze.posts_of_year(fx.posts(spark, sf), limit=500)


def _write_bronze_users(spark, sf, cfg):
    users, root = fx.users(spark, sf), cfg.bronze("users")
    bronze.ingest_span(users, root, *WIDE_YEARS)
    bronze.ingest_span(users.select(*USER_COLUMNS_NARROW), root, *NARROW_YEARS)
    return root


def bronze_named_years(spark, sf):
    """Write all years, then replace two that do not follow each other and one that has no users."""
    cfg = _workspace(spark, (1995, 2002))
    users, root = fx.users(spark, sf), cfg.bronze("users")
    bronze.ingest_years(users, root, cfg.years)
    later = users.where(F.col("Id") % 2 == 0).withColumn("CreationDate", F.regexp_replace("CreationDate", "^2000", "2003"))
    bronze.ingest_years(later, root, (1996, 1999, 2000))
    return files.read_span(spark, root, cfg.years, parse_dates(users).schema)


def bronze_users_by_year(spark, sf):
    """Write all years, then replace one of them by its narrow form, and read everything back."""
    cfg = _workspace(spark)
    root = _write_bronze_users(spark, sf, cfg)
    bronze.ingest_users(fx.users(spark, sf), root, YEAR, columns=USER_COLUMNS_NARROW)
    years = files.read_years(spark, root + "/year={year}", cfg.years, USERS)
    return union_aligned(
        df.withColumn("year", F.lit(year)) for year, df in zip(cfg.years, years)
    )


# --- alignment, stamps, casts --------------------------------------------------------------------


def union_years(spark, sf):
    dated = parse_dates(fx.users(spark, sf))
    created = F.col("CreationDate")
    wide = dated.where(in_years(created, *WIDE_YEARS))
    narrow = dated.where(in_years(created, *NARROW_YEARS)).select(*USER_COLUMNS_NARROW)
    return union_aligned([wide, narrow])


def stamp_users(spark, sf):
    return stamp_time(parse_dates(fx.users(spark, sf)), NEXT_STAMP)


def stamp_now(spark, sf):
    """Stamps taken from the clock: one per kind, not before the plan was made."""
    started = F.to_timestamp(F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S+00:00")))
    users = fx.users(spark, sf).select("Id")
    timed, dated = stamp_time(users), stamp_day(users)
    both = timed.join(dated.withColumnRenamed("fecha_cargue", "day"), "Id")
    recent = F.col("fecha_cargue").between(started, started + F.expr("INTERVAL 1 HOUR"))
    near = F.col("day").between(started.cast("date"), F.date_add(started.cast("date"), 1))
    return both.agg(
        F.count_distinct("fecha_cargue").alias("n_times"),
        F.count_distinct("day").alias("n_days"),
        F.count_if(recent & near).alias("n_in_bounds"),
    )


def parse_zoned_dates(spark, sf):
    """Text with offsets and zones, made from order dates, back to UTC."""
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    zone = F.element_at(F.array(*map(F.lit, _ZONES)), (F.col("o_orderkey") % len(_ZONES) + 1).cast("int"))
    zoned = F.concat(text, zone)
    return fx.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("Id"), tolerant_timestamp(zoned).alias("CreationDate")
    )


def conform_drift(spark, sf):
    """A batch with names in other cases, wider integers and integers that went through floats."""
    posts = fx.posts(spark, sf)
    drifted = posts.select(
        F.col("Id").alias("ID"),
        F.concat(F.col("PostTypeId").cast("string"), F.lit(".0")).alias("posttypeid"),
        F.col("Score").cast("bigint").alias("score"),
        F.col("ViewCount").cast("double").alias("VIEWCOUNT"),
        F.col("CreationDate").cast("string").alias("creationDate"),
        "OwnerUserId",
    )
    return conform(drifted, POSTS).select("Id", "PostTypeId", "Score", "ViewCount", "CreationDate", "OwnerUserId")


def settings_in_force(spark, sf):
    """Parameters from the environment, applied to a table."""
    cfg = Config.from_env({"WAREHOUSE": "s3a://lake/", "BRONZE_YEAR": "1995,1998", "BRONZE_LIMIT_USERS": "7"})
    users = parse_dates(fx.users(spark, sf))
    counts = [
        bronze.users_of_year(users, y, cfg.limit_users).agg(F.count("*").alias("n_rows")).select(F.lit(y).alias("year"), "n_rows")
        for y in cfg.years
    ]
    return counts[0].unionAll(counts[1])


def session_settings(spark, sf):
    """What a session that the library builds has in force, and what it counts. A setting that is
    fixed once the first session runs is not the library's to report here."""
    before = {k: spark.conf.get(k, None) for k in SESSION_DEFAULTS if spark.conf.isModifiable(k)}
    session = build_session("settings", Config(root="", session={"spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions")}))
    found = [(k, session.conf.get(k)) for k in before]
    for k, v in before.items():
        session.conf.unset(k) if v is None else session.conf.set(k, v)
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("name"), F.lit(v).alias("value")) for k, v in found)))
    counted = fx.table(session, sf, "nation").agg(F.count("*").alias("n_rows"))
    return counted.select(pairs.alias("s"), "n_rows").select("s.name", "s.value", "n_rows")


def cast_reputation(spark, sf):
    return fx.users(spark, sf).select("Id", tolerant_int(F.col("Reputation")).alias("Reputation"))


# --- upserts -------------------------------------------------------------------------------------


def anti_unchanged_query(spark, sf):
    known, batch = parse_dates(fx.users(spark, sf)), fx.users_batch(spark, sf)
    return anti_unchanged(known, batch, ["Id"])


def upsert_users(spark, sf):
    known, batch = _known_users(spark, sf), _new_users(spark, sf)
    return upsert(known, batch, ["Id"])


def upsert_users_schema_drift(spark, sf):
    known, batch = _known_users(spark, sf), _new_users(spark, sf, about=True)
    return upsert(known, batch, ["Id"])


def upsert_posts(spark, sf):
    known, batch = fx.posts(spark, sf), fx.posts_batch(spark, sf)
    return merge_into(known, batch, ["Id"])


def upsert_time_key(spark, sf):
    """Orders keyed by their date, which repeats: a date of the batch replaces all its rows."""
    orders = fx.table(spark, sf, "orders").select(F.col("o_orderdate").alias("Day"), F.col("o_orderkey").alias("Id"))
    batch = orders.where("Id % 50 = 0").select("Day", (-F.col("Id")).alias("Id"))
    return upsert(orders, batch, ["Day"])


def upsert_gold(spark, sf):
    posts, users = fx.posts(spark, sf), fx.users(spark, sf)
    recent = posts.where(in_years(F.col("CreationDate"), *NARROW_YEARS))
    known = stamp_day(gold.post_counts_by_user(posts, users), FIRST_DAY)
    fresh = stamp_day(gold.post_counts_by_user(recent, users), NEXT_DAY)
    return upsert(known, fresh, [m.OWNER])


def silver_users_table(spark, sf):
    """Create the users' history from the wide batch, then upsert the narrow one into it."""
    cfg = _workspace(spark)
    silver.build_users(spark, cfg, [parse_dates(fx.users(spark, sf))], FIRST_STAMP)
    return silver.build_users(spark, cfg, [parse_dates(fx.users_batch(spark, sf))], NEXT_STAMP)


def ranged_posts_other_config(spark, sf):
    """Posts cut into ranges by one configuration, upserted through another that names no width."""
    first = replace(_workspace(spark), range_width=10_000)
    silver.build_posts(spark, first, [fx.posts(spark, sf)], FIRST_STAMP)
    return silver.build_posts(spark, replace(first, range_width=None), [fx.posts_batch(spark, sf)], NEXT_STAMP)


def ranged_users_drift(spark, sf):
    """A batch without some of the table's columns and with one more, into a table with ranges."""
    cfg = replace(_workspace(spark), range_width=400)
    silver.upsert_table(spark, cfg, cfg.users_table, _known_users(spark, sf), ["Id"])
    return silver.upsert_table(spark, cfg, cfg.users_table, _new_users(spark, sf, about=True), ["Id"])


def gold_table_ranged(spark, sf):
    """The Gold table cut by ranges of its owner, then upserted from the posts of later years."""
    cfg = replace(_workspace(spark), range_width=500)
    posts, users = fx.posts(spark, sf), fx.users(spark, sf)
    recent = posts.where(in_years(F.col("CreationDate"), *NARROW_YEARS))
    tables.create_namespace(spark, cfg.silver, cfg.tables_root)
    tables.publish(users, cfg.users_table, cfg.tables_root)
    for part, day in ((posts, FIRST_DAY), (recent, NEXT_DAY)):
        tables.publish(part, cfg.posts_table, cfg.tables_root)
        gold.build_gold(spark, cfg, day)
    return silver.read_table(spark, cfg.gold_table)


def _upserted(spark, known, batch, keys, **settings):
    """A table of its own with ``known``, upserted by ``batch``, under settings for its ranges."""
    cfg = replace(_workspace(spark), **settings)
    name = f"{cfg.silver}.kept"
    silver.upsert_table(spark, cfg, name, known, keys)
    return silver.upsert_table(spark, cfg, name, batch, keys)


def ranged_time_key(spark, sf):
    """Orders in a table cut by ranges of 90 days of their date; a date of the batch replaces all its rows."""
    orders = fx.table(spark, sf, "orders").select(F.col("o_orderdate").alias("Day"), F.col("o_orderkey").alias("Id"))
    batch = orders.where("Id % 50 = 0").select("Day", (-F.col("Id")).alias("Id"))
    day = F.col("Day").cast("date")
    return _upserted(spark, orders.withColumn("Day", day), batch.withColumn("Day", day), ["Day"], range_width=90)


def ranged_two_keys(spark, sf):
    """Order lines in a table cut by hashes of order and line; the batch brings later ones and new ones."""
    lines = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    batch = lines.where("l_orderkey % 100 = 7").withColumn("l_quantity", -F.col("l_quantity"))
    added = batch.withColumn("l_orderkey", -F.col("l_orderkey"))
    return _upserted(spark, lines, batch.unionByName(added), ["l_orderkey", "l_linenumber"], range_rows=10_000)


def ranged_text_key(spark, sf):
    """Customers by name, cut by hashes of it."""
    people = fx.table(spark, sf, "customer").select("c_name", "c_nationkey")
    batch = people.where("c_nationkey = 3").withColumn("c_nationkey", F.col("c_nationkey") - 100)
    return _upserted(spark, people, batch, ["c_name"], range_width=2**28)


def one_piece_to_ranges(spark, sf):
    """Users in a table without ranges, which the next upsert cuts, and one more into its ranges."""
    cfg = _workspace(spark)
    cut = replace(cfg, range_rows=200)
    silver.upsert_table(spark, cfg, cfg.users_table, _known_users(spark, sf), ["Id"])
    silver.upsert_table(spark, cut, cfg.users_table, _known_users(spark, sf).where("Id % 7 = 0"), ["Id"])
    return silver.upsert_table(spark, cfg, cfg.users_table, _new_users(spark, sf, about=True), ["Id"])


def silver_posts_table(spark, sf):
    """Posts cut into ranges of about so many rows, created and then merged into."""
    cfg = replace(_workspace(spark), range_rows=20_000)
    silver.build_posts(spark, cfg, [fx.posts(spark, sf)], FIRST_STAMP)
    return silver.build_posts(spark, cfg, [fx.posts_batch(spark, sf)], NEXT_STAMP)


# --- table lifecycle -----------------------------------------------------------------------------


def register_posts(spark, sf):
    cfg = _workspace(spark)
    return silver.register(spark, cfg, cfg.posts_table, [fx.posts_wide(spark, sf)])


def rebuild_posts_light(spark, sf):
    """Register the wide posts, then replace the table by one without the wide text."""
    cfg = _workspace(spark)
    wide = fx.posts_wide(spark, sf)
    silver.register(spark, cfg, cfg.posts_table, [wide])
    return silver.rebuild_posts_light(spark, cfg, [wide], NEXT_STAMP)


def overwrite_from_self(spark, sf):
    """Replace a table by a plan that reads the same table."""
    cfg = _workspace(spark)
    silver.register(spark, cfg, cfg.posts_table, [fx.posts(spark, sf)])
    tables.publish(m.owned(spark.table(cfg.posts_table)), cfg.posts_table, cfg.tables_root)
    return spark.table(cfg.posts_table)


def publish_adds_column(spark, sf):
    """Publish users, then users with one more column in another order, over the same table."""
    cfg = _workspace(spark)
    users = parse_dates(fx.users(spark, sf))
    silver.register(spark, cfg, cfg.users_table, [users])
    more = users.withColumn("Karma", F.col("Views").cast("bigint") * 2)
    tables.publish(more.select("Karma", *users.columns), cfg.users_table, cfg.tables_root)
    tables.expire(spark, cfg.users_table, cfg.tables_root, keep=0)
    return spark.table(cfg.users_table)


# --- measures ------------------------------------------------------------------------------------


def _by_owner(spark, sf, **measures):
    grouped = m.owned(fx.posts(spark, sf)).groupBy(m.OWNER)
    return grouped.agg(*(c.alias(n) for n, c in measures.items()))


def agg_count(spark, sf):
    return _by_owner(spark, sf, total_posts=m.count_filled("Id"))


def agg_conditional_count(spark, sf):
    counts = {name: m.count_of_type(code) for name, code in m.TYPE_COUNTS.items()}
    return _by_owner(spark, sf, **counts)


def agg_sum(spark, sf):
    return _by_owner(spark, sf, **{name: m.total(column) for name, column in m.SUMS.items()})


def agg_avg_round(spark, sf):
    return _by_owner(spark, sf, score_promedio=m.mean_rounded("Score"))


def agg_owner_metrics(spark, sf):
    return m.owner_metrics(fx.posts(spark, sf))


# --- Gold ----------------------------------------------------------------------------------------


def join_owner_users(spark, sf):
    return gold.with_users(agg_count(spark, sf), fx.users(spark, sf))


def gold_post_counts(spark, sf):
    return gold.post_counts_by_user(fx.posts(spark, sf), fx.users(spark, sf))


def gold_hot_users(spark, sf):
    """User rows that repeat, one Id with a fifth of all, met by owners who have that Id."""
    users = fx.users(spark, sf)
    line = fx.table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") == 1, 1).otherwise(F.col("l_orderkey")).cast("long").alias("Id"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("DisplayName"),
    )
    many = line.unionByName(users.select("Id", "DisplayName"))
    per_owner = agg_count(spark, sf)
    joined = skew.spread_left_join(per_owner, many, m.OWNER, "Id", rows_per_split=500)
    return joined.groupBy(m.OWNER, "total_posts").agg(
        F.count("DisplayName").alias("n_names"), F.count_distinct("DisplayName").alias("n_distinct")
    )


def gold_stamped(spark, sf):
    return stamp_day(gold_post_counts(spark, sf), NEXT_DAY)


def pipeline_gold(spark, sf):
    """Bronze years, Silver tables and Gold table in order, twice over the same sources."""
    cfg = _workspace(spark)
    posts, users = fx.posts(spark, sf), fx.users(spark, sf)
    pipeline.run_pipeline(spark, cfg, posts, users, FIRST_STAMP, FIRST_DAY)
    return pipeline.run_pipeline(spark, cfg, posts, users, NEXT_STAMP, NEXT_DAY)


# --- serving, audit ------------------------------------------------------------------------------


def serve_gold_from_silver(spark, sf):
    return serving.gold_from_silver(fx.posts(spark, sf), fx.users(spark, sf))


def serve_sums_coalesced(spark, sf):
    sums = {name: m.total_or_zero(column) for name, column in serving.SERVED_SUMS.items()}
    return _by_owner(spark, sf, **sums)


def serve_top_owners(spark, sf):
    return serving.top_owners(fx.posts(spark, sf), fx.users(spark, sf))


def serve_preview_top20(spark, sf):
    tables.view(gold_post_counts(spark, sf), "post_counts_by_user")
    return spark.sql("SELECT * FROM post_counts_by_user ORDER BY OwnerUserId LIMIT 20")


def audit_row_counts(spark, sf):
    return row_counts({name: fx.table(spark, sf, name) for name in GIVEN_TABLES})


def audit_table_report(spark, sf):
    """Counts of two catalog tables, of one that is not there and of one whose files are gone."""
    cfg = _workspace(spark)
    silver.register(spark, cfg, cfg.posts_table, [fx.posts(spark, sf)])
    silver.register(spark, cfg, cfg.users_table, [fx.users(spark, sf)])
    lost = f"{cfg.silver}.lost"
    spark.catalog.createTable(lost, path=f"{cfg.tables_root}/nowhere", source="parquet", schema=USERS)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{cfg.tables_root}/nowhere")
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    report = table_report(spark, [cfg.posts_table, cfg.users_table, cfg.gold_table, lost])
    short = F.element_at(F.split("table_name", r"\."), -1)
    return report.select(
        short.alias("table_name"), "n_rows", F.col("error").isNotNull().alias("failed")
    )


def audit_bronze_files(spark, sf):
    """Files with rows, files without any, and a place that is not there."""
    root = _workspace(spark).root
    fx.table(spark, sf, "nation").limit(0).coalesce(1).write.parquet(f"{root}/empty")
    paths = [f"{sf}/orders.parquet", f"{sf}/customer.parquet", f"{root}/empty", f"{root}/absent"]
    listed = files.rows_per_file(spark, paths)
    name = F.element_at(F.split("file_path", "/"), -1)
    known = F.when(name.startswith("part-"), "empty").otherwise(name)
    return listed.select(known.alias("file_name"), "n_rows", F.col("error").alias("error"))


def queries() -> dict[str, Query]:
    return {**_own_queries(), **_llm_queries()}


def _llm_queries() -> dict[str, Query]:
    return {} if llm is None else {**llm.queries(), "pipeline": corpus_pipeline.run}


def _own_queries() -> dict[str, Query]:
    return {
        "scan_posts": scan_posts,
        "scan_posts_light": scan_posts_light,
        "scan_limit": scan_limit,
        "catalog_scan": catalog_scan,
        "parse_dates": parse_dates_query,
        "filter_year": filter_year_query,
        "drop_null_dates": drop_null_dates_query,
        "ingest_users_year": ingest_users_year,
        "ingest_users_capped": ingest_users_capped,
        "ingest_posts_capped": ingest_posts_capped,
        "bronze_users_by_year": bronze_users_by_year,
        "bronze_named_years": bronze_named_years,
        "union_years": union_years,
        "stamp_users": stamp_users,
        "stamp_now": stamp_now,
        "parse_zoned_dates": parse_zoned_dates,
        "conform_drift": conform_drift,
        "settings_in_force": settings_in_force,
        "session_settings": session_settings,
        "cast_reputation": cast_reputation,
        "anti_unchanged": anti_unchanged_query,
        "upsert_users": upsert_users,
        "upsert_users_schema_drift": upsert_users_schema_drift,
        "upsert_posts": upsert_posts,
        "upsert_time_key": upsert_time_key,
        "upsert_gold": upsert_gold,
        "silver_users_table": silver_users_table,
        "silver_posts_table": silver_posts_table,
        "ranged_posts_other_config": ranged_posts_other_config,
        "ranged_users_drift": ranged_users_drift,
        "gold_table_ranged": gold_table_ranged,
        "ranged_time_key": ranged_time_key,
        "ranged_two_keys": ranged_two_keys,
        "ranged_text_key": ranged_text_key,
        "one_piece_to_ranges": one_piece_to_ranges,
        "register_posts": register_posts,
        "rebuild_posts_light": rebuild_posts_light,
        "overwrite_from_self": overwrite_from_self,
        "publish_adds_column": publish_adds_column,
        "agg_count": agg_count,
        "agg_conditional_count": agg_conditional_count,
        "agg_sum": agg_sum,
        "agg_avg_round": agg_avg_round,
        "agg_owner_metrics": agg_owner_metrics,
        "join_owner_users": join_owner_users,
        "gold_post_counts": gold_post_counts,
        "gold_hot_users": gold_hot_users,
        "gold_stamped": gold_stamped,
        "pipeline_gold": pipeline_gold,
        "serve_gold_from_silver": serve_gold_from_silver,
        "serve_sums_coalesced": serve_sums_coalesced,
        "serve_top_owners": serve_top_owners,
        "serve_preview_top20": serve_preview_top20,
        "audit_row_counts": audit_row_counts,
        "audit_table_report": audit_table_report,
        "audit_bronze_files": audit_bronze_files,
    }


# --- oracle --------------------------------------------------------------------------------------

_POSTS = f"({fx.POSTS_SQL})"
_WIDE = f"({fx.POSTS_WIDE_SQL})"
_LATER_POSTS = f"({fx.POSTS_BATCH_SQL})"
_RAW_USERS = f"({fx.USERS_RAW_SQL})"
_USERS = f"({fx.USERS_SQL})"
_LATER_USERS = f"({fx.USERS_BATCH_SQL})"
_LIGHT = ", ".join(POST_COLUMNS)
_NARROW = ", ".join(USER_COLUMNS_NARROW)
_NO_ATTRIBUTES = (
    "CAST(NULL AS VARCHAR) AS DisplayName, CAST(NULL AS VARCHAR) AS Location, "
    "CAST(NULL AS INT) AS Views, CAST(NULL AS INT) AS UpVotes, CAST(NULL AS INT) AS DownVotes"
)
_STAMPED_FIRST = "TIMESTAMP '2023-01-01 00:00:00' AS fecha_cargue"
_STAMPED_NEXT = "TIMESTAMP '2024-01-01 00:00:00' AS fecha_cargue"


def _between(first: int, last: int) -> str:
    return f"CreationDate >= TIMESTAMP '{first}-01-01' AND CreationDate < TIMESTAMP '{last + 1}-01-01'"


# Half-up on the decimal digits of the average, which is what Spark rounds.
_ROUNDED_AVG = (
    "CAST(ROUND(CAST(CAST(AVG(Score) AS VARCHAR) AS DECIMAL(38, 20)), 2) AS DOUBLE) "
    "AS score_promedio"
)
_COUNTS = """COUNT(CASE WHEN PostTypeId = 1 THEN 1 END) AS total_preguntas,
       COUNT(CASE WHEN PostTypeId = 2 THEN 1 END) AS total_respuestas"""
_SUMS = """CAST(SUM(Score) AS BIGINT) AS total_score,
       CAST(SUM(ViewCount) AS BIGINT) AS total_views,
       CAST(SUM(CommentCount) AS BIGINT) AS total_comments,
       CAST(SUM(AnswerCount) AS BIGINT) AS total_answers_received"""
_ZERO_SUMS = """CAST(SUM(COALESCE(CAST(Score AS INTEGER), 0)) AS BIGINT) AS total_score,
       CAST(SUM(COALESCE(CAST(ViewCount AS INTEGER), 0)) AS BIGINT) AS total_views,
       CAST(SUM(COALESCE(CAST(CommentCount AS INTEGER), 0)) AS BIGINT) AS total_comments"""


def _per_owner(measures: str, posts: str = _POSTS) -> str:
    return f"""SELECT OwnerUserId, {measures}
FROM {posts} WHERE OwnerUserId IS NOT NULL GROUP BY OwnerUserId"""


def _metrics(posts: str = _POSTS) -> str:
    return _per_owner(f"COUNT(Id) AS total_posts, {_COUNTS}, {_SUMS}, {_ROUNDED_AVG}", posts)


def _joined(metrics: str, users: str = _RAW_USERS, extra: str = "") -> str:
    return f"""SELECT g.*, u.DisplayName,
       TRY_CAST(split_part(u.Reputation, '.', 1) AS INTEGER) AS Reputation,
       u.Location, u.Views, u.UpVotes, u.DownVotes{extra}
FROM ({metrics}) g LEFT JOIN {users} u ON g.OwnerUserId = u.Id"""


_GOLD = _joined(_metrics())
_DAY_FIRST, _DAY_NEXT = ", DATE '2023-01-01' AS fecha_cargue", ", DATE '2024-01-01' AS fecha_cargue"
_USERS_BY_SHAPE = f"""(SELECT * FROM {_USERS} WHERE {_between(*WIDE_YEARS)}
UNION ALL SELECT {_NARROW}, {_NO_ATTRIBUTES} FROM {_USERS} WHERE {_between(*NARROW_YEARS)})"""

_RECENT_GOLD = _joined(
    _metrics(f"(SELECT * FROM {_POSTS} WHERE {_between(*NARROW_YEARS)})"), extra=_DAY_NEXT
)

# Each owner's sums, times the copies of each distinct name and place among the owner's user rows.
_SERVED_COUNTS = (
    "COUNT(*) AS total_posts, COUNT(*) FILTER (PostTypeId = 1) AS total_preguntas, "
    f"COUNT(*) FILTER (PostTypeId = 2) AS total_respuestas, {_ZERO_SUMS}"
)
_SERVED_NAMES = (
    "total_posts", "total_preguntas", "total_respuestas", "total_score", "total_views", "total_comments"
)
_SERVED = f"""
WITH per_owner AS ({_per_owner(_SERVED_COUNTS)}), people AS (
  SELECT Id, DisplayName, Location, COUNT(*) AS copies FROM {_RAW_USERS} GROUP BY ALL
)
SELECT OwnerUserId, {", ".join(f"CAST({n} * COALESCE(copies, 1) AS BIGINT) AS {n}" for n in _SERVED_NAMES)},
       DisplayName, Location
FROM per_owner LEFT JOIN people ON Id = OwnerUserId"""

_UPSERTED_USERS = f"""
SELECT *, {_STAMPED_FIRST} FROM {_USERS} WHERE Id NOT IN (SELECT Id FROM {_LATER_USERS})
UNION ALL SELECT {_NARROW}, {_NO_ATTRIBUTES}, {_STAMPED_NEXT} FROM {_LATER_USERS}"""

_UPSERTED_USERS_DRIFT = f"""
SELECT *, {_STAMPED_FIRST}, CAST(NULL AS VARCHAR) AS AboutMe
FROM {_USERS} WHERE Id NOT IN (SELECT Id FROM {_LATER_USERS})
UNION ALL SELECT {_NARROW}, {_NO_ATTRIBUTES}, {_STAMPED_NEXT}, AboutMe FROM {_LATER_USERS}"""


# What every session of the library has in force.
_SETTINGS = """('spark.sql.session.timeZone', 'UTC'), ('spark.sql.adaptive.enabled', 'true'),
('spark.sql.adaptive.coalescePartitions.enabled', 'true'), ('spark.sql.adaptive.skewJoin.enabled', 'true'),
('spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold', '64m'), ('spark.sql.parquet.compression.codec', 'snappy')"""


def _upserted_posts(first: str = "", following: str = "") -> str:
    return f"""
SELECT {_LIGHT}{first} FROM {_POSTS} WHERE Id NOT IN (SELECT Id FROM {_LATER_POSTS})
UNION ALL SELECT {_LIGHT}{following} FROM {_LATER_POSTS}"""


def oracle_sql() -> dict[str, str]:
    return {**_own_oracle_sql(), **_llm_oracle_sql()}


def _llm_oracle_sql() -> dict[str, str]:
    if llm is None:
        return {}
    whole = corpus_pipeline.ORACLE_SQL
    return {**llm.oracle_sql(), **({"pipeline": whole} if whole else {})}


def _own_oracle_sql() -> dict[str, str]:
    return {
        "scan_posts": fx.POSTS_WIDE_SQL,
        "scan_posts_light": f"SELECT {_LIGHT} FROM {_WIDE}",
        "catalog_scan": fx.USERS_SQL,
        "parse_dates": f"SELECT Id, CreationDate FROM {_USERS}",
        "filter_year": f"SELECT * FROM {_POSTS} WHERE year(CreationDate) = {YEAR}",
        "drop_null_dates": f"SELECT * FROM {_USERS} WHERE CreationDate IS NOT NULL",
        "ingest_users_year": f"SELECT {_NARROW} FROM {_USERS} WHERE year(CreationDate) = {YEAR}",
        "ingest_users_capped": f"""SELECT * FROM {_USERS} WHERE year(CreationDate) = {YEAR}
ORDER BY Id LIMIT 100""",
        "ingest_posts_capped": f"SELECT * FROM {_POSTS} ORDER BY Id LIMIT 500",
        "bronze_users_by_year": f"""
SELECT *, CAST(year(CreationDate) AS INT) AS year FROM {_USERS}
WHERE {_between(*WIDE_YEARS)} AND year(CreationDate) <> {YEAR}
UNION ALL
SELECT {_NARROW}, {_NO_ATTRIBUTES}, CAST(year(CreationDate) AS INT) AS year FROM {_USERS}
WHERE {_between(*NARROW_YEARS)} OR year(CreationDate) = {YEAR}""",
        "union_years": f"SELECT * FROM {_USERS_BY_SHAPE}",
        "stamp_users": f"SELECT *, {_STAMPED_NEXT} FROM {_USERS}",
        "scan_limit": f"SELECT LEAST(COUNT(*), 20) AS n_rows, LEAST(COUNT(*), 20) AS n_known FROM {_POSTS}",
        "stamp_now": f"""
SELECT CAST(1 AS BIGINT) AS n_times, CAST(1 AS BIGINT) AS n_days, COUNT(*) AS n_in_bounds FROM {_RAW_USERS}""",
        "parse_zoned_dates": """
SELECT o_orderkey AS Id, CASE o_orderkey % 5
         WHEN 1 THEN o_orderdate - INTERVAL 5 HOURS
         WHEN 2 THEN o_orderdate + INTERVAL 210 MINUTES
         WHEN 4 THEN timezone('UTC', timezone('Europe/Paris', CAST(o_orderdate AS TIMESTAMP)))
         ELSE CAST(o_orderdate AS TIMESTAMP) END AS CreationDate
FROM orders""",
        "conform_drift": f"SELECT Id, PostTypeId, Score, ViewCount, CreationDate, OwnerUserId FROM {_POSTS}",
        "settings_in_force": f"""
SELECT CAST(y AS INT) AS year, LEAST(7, (SELECT COUNT(*) FROM {_USERS} WHERE year(CreationDate) = y)) AS n_rows
FROM (VALUES (1995), (1998)) years(y)""",
        "upsert_time_key": """
SELECT o_orderdate AS Day, o_orderkey AS Id FROM orders
WHERE o_orderdate NOT IN (SELECT o_orderdate FROM orders WHERE o_orderkey % 50 = 0)
UNION ALL SELECT o_orderdate, -o_orderkey FROM orders WHERE o_orderkey % 50 = 0""",
        "ranged_time_key": """
SELECT CAST(o_orderdate AS DATE) AS Day, o_orderkey AS Id FROM orders
WHERE CAST(o_orderdate AS DATE) NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 50 = 0)
UNION ALL SELECT CAST(o_orderdate AS DATE), -o_orderkey FROM orders WHERE o_orderkey % 50 = 0""",
        "ranged_two_keys": """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 100 = 7 THEN -l_quantity ELSE l_quantity END AS l_quantity
FROM lineitem
UNION ALL SELECT -l_orderkey, l_linenumber, -l_quantity FROM lineitem WHERE l_orderkey % 100 = 7""",
        "ranged_text_key": """
SELECT c_name, CAST(CASE WHEN c_nationkey = 3 THEN -97 ELSE c_nationkey END AS INT) AS c_nationkey FROM customer""",
        "one_piece_to_ranges": _UPSERTED_USERS_DRIFT,
        "publish_adds_column": f"SELECT *, CAST(Views AS BIGINT) * 2 AS Karma FROM {_USERS}",
        "gold_hot_users": f"""
WITH many AS (
  SELECT CAST(CASE WHEN l_linenumber = 1 THEN 1 ELSE l_orderkey END AS BIGINT) AS Id,
         'line ' || l_linenumber AS DisplayName FROM lineitem
  UNION ALL SELECT Id, DisplayName FROM {_RAW_USERS}
)
SELECT OwnerUserId, total_posts, COUNT(DisplayName) AS n_names, COUNT(DISTINCT DisplayName) AS n_distinct
FROM ({_per_owner("COUNT(Id) AS total_posts")}) LEFT JOIN many ON many.Id = OwnerUserId
GROUP BY OwnerUserId, total_posts""",
        "cast_reputation": f"""
SELECT Id, TRY_CAST(split_part(Reputation, '.', 1) AS INTEGER) AS Reputation FROM {_RAW_USERS}""",
        "anti_unchanged": f"""
SELECT * FROM {_USERS} WHERE Id NOT IN (SELECT Id FROM {_LATER_USERS})""",
        "upsert_users": _UPSERTED_USERS,
        "upsert_users_schema_drift": _UPSERTED_USERS_DRIFT,
        "upsert_posts": _upserted_posts(),
        "upsert_gold": f"""
WITH fresh AS ({_RECENT_GOLD}), known AS ({_joined(_metrics(), extra=_DAY_FIRST)})
SELECT * FROM known WHERE OwnerUserId NOT IN (SELECT OwnerUserId FROM fresh)
UNION ALL SELECT * FROM fresh""",
        "silver_users_table": _UPSERTED_USERS,
        "silver_posts_table": _upserted_posts(f", {_STAMPED_FIRST}", f", {_STAMPED_NEXT}"),
        "ranged_posts_other_config": _upserted_posts(f", {_STAMPED_FIRST}", f", {_STAMPED_NEXT}"),
        "ranged_users_drift": _UPSERTED_USERS_DRIFT,
        "gold_table_ranged": f"""
WITH fresh AS ({_RECENT_GOLD}), known AS ({_joined(_metrics(), extra=_DAY_FIRST)})
SELECT * FROM known WHERE OwnerUserId NOT IN (SELECT OwnerUserId FROM fresh)
UNION ALL SELECT * FROM fresh""",
        "bronze_named_years": f"""
SELECT * FROM {_USERS} WHERE {_between(1995, 2002)}
AND (year(CreationDate) NOT IN (1996, 1999, 2000) OR (year(CreationDate) <> 2000 AND Id % 2 = 0))""",
        "session_settings": f"""
SELECT name, value, (SELECT COUNT(*) FROM nation) AS n_rows FROM (VALUES {_SETTINGS}) settings(name, value)""",
        "register_posts": fx.POSTS_WIDE_SQL,
        "rebuild_posts_light": f"SELECT {_LIGHT}, {_STAMPED_NEXT} FROM {_WIDE}",
        "overwrite_from_self": f"SELECT * FROM {_POSTS} WHERE OwnerUserId IS NOT NULL",
        "agg_count": _per_owner("COUNT(Id) AS total_posts"),
        "agg_conditional_count": _per_owner(_COUNTS),
        "agg_sum": _per_owner(_SUMS),
        "agg_avg_round": _per_owner(_ROUNDED_AVG),
        "agg_owner_metrics": _metrics(),
        "join_owner_users": _joined(_per_owner("COUNT(Id) AS total_posts")),
        "gold_post_counts": _GOLD,
        "gold_stamped": _joined(_metrics(), extra=_DAY_NEXT),
        "pipeline_gold": _joined(
            _metrics(), users=f"(SELECT * FROM {_USERS} WHERE {_between(1995, 2001)})", extra=_DAY_NEXT
        ),
        "serve_gold_from_silver": _SERVED,
        "serve_sums_coalesced": _per_owner(_ZERO_SUMS),
        "serve_top_owners": f"""{_SERVED}
ORDER BY total_posts DESC, OwnerUserId, DisplayName, Location LIMIT 20""",
        "serve_preview_top20": f"SELECT * FROM ({_GOLD}) ORDER BY OwnerUserId LIMIT 20",
        "audit_row_counts": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in GIVEN_TABLES
        ),
        "audit_table_report": f"""
SELECT 'posts_hist' AS table_name, COUNT(*) AS n_rows, FALSE AS failed FROM {_POSTS}
UNION ALL SELECT 'users_hist', COUNT(*), FALSE FROM {_RAW_USERS}
UNION ALL SELECT 'post_counts_by_user', CAST(NULL AS BIGINT), TRUE
UNION ALL SELECT 'lost', CAST(NULL AS BIGINT), TRUE""",
        "audit_bronze_files": """
SELECT 'orders.parquet' AS file_name, COUNT(*) AS n_rows, CAST(NULL AS VARCHAR) AS error FROM orders
UNION ALL SELECT 'customer.parquet', COUNT(*), NULL FROM customer
UNION ALL SELECT 'empty', 0, NULL UNION ALL SELECT 'absent', NULL, 'missing'""",
    }

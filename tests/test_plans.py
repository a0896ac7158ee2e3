"""What the plans must look like: what is read, what is shuffled, what is not."""

import re

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from given import SF_SMALL
from layerloom.functions.dates import filter_year, parse_dates
from layerloom.operators.metrics import owner_metrics
from layerloom.operators.upsert import upsert
from layerloom.plans import bronze, gold, serving
from layerloom.schemas import POST_COLUMNS, POSTS
from layerloom.sources import files, tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text):
    return len(re.findall(r"Exchange (?:hash|range|SinglePartition|RoundRobin)", text))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Posts and users as typed files, so that pushdown can be seen."""
    root = str(tmp_path_factory.mktemp("stored"))
    fx.posts_wide(spark, SF_SMALL).write.parquet(f"{root}/wide")
    fx.posts(spark, SF_SMALL).write.parquet(f"{root}/posts")
    parse_dates(fx.users(spark, SF_SMALL)).write.parquet(f"{root}/users")
    return lambda name: files.read_entity(spark, f"{root}/{name}")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_light_scan_never_reads_the_body(stored):
    text = plan(stored("wide").select(*POST_COLUMNS))
    assert "Body" not in text and "ReadSchema" in text


def test_projection_on_read(spark, stored, tmp_path):
    fx.posts(spark, SF_SMALL).write.parquet(str(tmp_path / "p"))
    df = files.read_entity(spark, str(tmp_path / "p"), columns=["Id", "Score"], schema=POSTS)
    assert "ReadSchema: struct<Id:bigint,Score:int>" in plan(df)


def test_year_filter_is_pushed_as_a_range(stored):
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan(filter_year(stored("posts"), 1998)))
    assert "GreaterThanOrEqual(CreationDate" in pushed.group(1)
    assert "LessThan(CreationDate" in pushed.group(1)


def test_typed_dates_stay_pushable_through_bronze(stored):
    text = plan(bronze.users_of_year(stored("users"), 1998))
    assert "GreaterThanOrEqual(CreationDate" in text


def test_metrics_read_their_columns_and_combine_before_the_shuffle(stored):
    text = plan(owner_metrics(stored("posts")))
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "Id", "OwnerUserId", "PostTypeId", "Score", "ViewCount", "CommentCount", "AnswerCount",
    }
    assert "IsNotNull(OwnerUserId)" in text
    assert text.index("partial_sum") > text.index("Exchange hashpartitioning")
    assert exchanges(text) == 1


def test_gold_shuffles_posts_once_and_users_once(stored, no_broadcast):
    text = plan(gold.post_counts_by_user(stored("posts"), stored("users")))
    assert exchanges(text) == 2
    assert "_salt" not in text and "Broadcast" not in text


def test_report_combines_both_sides_before_they_meet(stored, no_broadcast):
    text = plan(serving.gold_from_silver(stored("posts"), stored("users")))
    # Users once by name to count copies, once by Id to meet their posts.
    assert exchanges(text) == 3 and text.count("partial_count(1)") >= 2


def test_top_owners_never_sorts_everything(stored):
    text = plan(serving.top_owners(stored("posts"), stored("users")))
    assert "TakeOrderedAndProject(limit=20" in text and "rangepartitioning" not in text


def test_small_batch_leaves_the_table_unshuffled(stored):
    known = stored("users")
    text = plan(upsert(known, known.limit(5), ["Id"]))
    kept = text[text.index("LeftAnti"):]
    assert "BroadcastHashJoin [Id" in text
    assert exchanges(kept[: kept.index("BroadcastExchange")]) == 0


def test_large_batch_moves_keys_only_to_the_join(stored, no_broadcast):
    known = stored("posts")
    text = plan(upsert(known, stored("posts").withColumn("Score", F.lit(1)), ["Id"]))
    assert "SortMergeJoin [Id" in text and "LeftAnti" in text
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert "Id:bigint" in schemas
    assert exchanges(text) == 2


def test_building_a_plan_runs_no_job(spark, stored):
    posts, users = stored("posts"), stored("users")
    posts.schema, users.schema
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plans")
    for spread in (False, True):
        gold.post_counts_by_user(posts, users, spread)
        serving.gold_from_silver(posts, users, spread)
    upsert(posts, posts, ["Id"])
    assert list(tracker.getJobIdsForGroup("plans")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_upsert_leaves_other_ranges_alone(spark, cfg, stored):
    """Only the ranges with keys of the batch are read, written and pointed at anew."""
    name = f"{cfg.silver}.ranged"
    tables.create_namespace(spark, cfg.silver, cfg.tables_root)
    posts = stored("posts").select("Id", "Score")
    tables.create_ranges(posts, name, cfg.tables_root, "Id", 500)
    before = tables._range_locations(spark, name)
    assert len(before) > 2
    batch = posts.where("Id BETWEEN 500 AND 510").withColumn("Score", F.lit(-777)).select("Id", "Score")
    seen = {}

    def combine(existing, incoming, keys):
        seen["plan"] = plan(existing)
        seen["files"] = existing.inputFiles()
        return upsert(existing, incoming, keys)

    with tables.staged(batch, cfg.staging_root) as staged:
        tables.upsert_ranges(staged, name, cfg.tables_root, combine)
    assert "PartitionFilters" in seen["plan"] and all("key_range=1/" in f for f in seen["files"])
    after = tables._range_locations(spark, name)
    assert {k for k in before if before[k] != after[k]} == {"1"} and set(after) == set(before)
    found = spark.table(name)
    assert found.count() == posts.count() and found.where("Score = -777").count() == batch.count()
    tables.expire(spark, name, cfg.tables_root, keep=0)
    assert spark.table(name).count() == posts.count()


def test_no_python_in_any_plan(spark, stored):
    out = gold.post_counts_by_user(stored("posts"), stored("users"))
    for df in (out, serving.top_owners(stored("posts"), stored("users"))):
        assert not re.search(r"Python|ArrowEval|MapInPandas", plan(df))

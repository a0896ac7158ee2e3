from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from given import SF_SMALL
from layerloom.config import Config, build_session, shared_folder
from layerloom.functions.dates import parse_dates
from layerloom.operators.audit import row_counts, table_report
from layerloom.plans import bronze, gold, pipeline, silver
from layerloom.schemas import USER_COLUMNS_NARROW, USERS
from layerloom.sources import files, tables

AT, LATER = datetime(2023, 1, 1), datetime(2024, 1, 1)


@pytest.fixture
def name(spark, cfg):
    tables.create_namespace(spark, cfg.silver, cfg.tables_root)
    return f"{cfg.silver}.things"


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_create_fails_when_present(spark, cfg, name):
    tables.create(spark.range(2), name, cfg.tables_root)
    with pytest.raises(ValueError, match="already exists"):
        tables.create(spark.range(3), name, cfg.tables_root)
    assert ids(spark.table(name)) == [0, 1]


def test_publish_may_read_what_it_replaces(spark, cfg, name):
    tables.publish(spark.range(4), name, cfg.tables_root)
    tables.publish(spark.table(name).where("id > 1"), name, cfg.tables_root)
    assert ids(spark.table(name)) == [2, 3]


def test_planned_reader_keeps_the_old_version(spark, cfg, name):
    tables.publish(spark.range(2), name, cfg.tables_root)
    before = spark.table(name)
    tables.publish(spark.range(5, 7), name, cfg.tables_root)
    assert ids(before) == [0, 1]
    assert ids(spark.table(name)) == [5, 6]


def test_failed_publish_leaves_the_table(spark, cfg, name):
    tables.publish(spark.range(2), name, cfg.tables_root)
    broken = spark.range(3).select(F.raise_error(F.lit("stop")).cast("long").alias("id"))
    with pytest.raises(Exception, match="stop"):
        tables.publish(broken, name, cfg.tables_root)
    assert ids(spark.table(name)) == [0, 1]


def test_publish_adds_new_columns_at_the_end(spark, cfg, name):
    tables.publish(spark.range(2), name, cfg.tables_root)
    tables.publish(spark.sql("SELECT 'x' AS tag, 7L AS id"), name, cfg.tables_root)
    assert spark.table(name).columns == ["id", "tag"]
    assert [tuple(r) for r in spark.table(name).collect()] == [(7, "x")]


def test_rebuild_replaces_the_columns(spark, cfg, name):
    tables.rebuild(spark.sql("SELECT 'x' AS tag, 7L AS id"), name, cfg.tables_root)
    tables.rebuild(spark.range(1), name, cfg.tables_root)
    assert spark.table(name).columns == ["id"]
    tables.rebuild(spark.sql("SELECT 'seven' AS id"), name, cfg.tables_root)
    assert spark.table(name).dtypes == [("id", "string")]
    assert [t.name for t in spark.catalog.listTables(cfg.silver) if not t.isTemporary] == ["things"]


def test_rebuild_that_fails_midway_leaves_the_table(spark, cfg, name, monkeypatch):
    tables.rebuild(spark.range(3), name, cfg.tables_root)
    rename, calls = tables._rename, []

    def second_fails(session, old, new):
        calls.append(new)
        if len(calls) == 2:
            raise RuntimeError("catalog is away")
        rename(session, old, new)

    monkeypatch.setattr(tables, "_rename", second_fails)
    with pytest.raises(RuntimeError):
        tables.rebuild(spark.sql("SELECT 'x' AS tag"), name, cfg.tables_root)
    assert spark.table(name).count() == 3


def test_publish_refuses_lost_and_retyped_columns(spark, cfg, name):
    tables.publish(spark.sql("SELECT 1 AS id, 'x' AS tag"), name, cfg.tables_root)
    with pytest.raises(ValueError, match="lose columns: tag"):
        tables.publish(spark.sql("SELECT 1 AS id"), name, cfg.tables_root)
    for retyped in ("SELECT '1' AS id, 'x' AS tag", "SELECT 1L AS id, 'x' AS tag"):
        with pytest.raises(ValueError, match="types of: id"):
            tables.publish(spark.sql(retyped), name, cfg.tables_root)
    tables.publish(spark.sql("SELECT CAST(2 AS SMALLINT) AS id, 'y' AS tag"), name, cfg.tables_root)
    assert spark.table(name).dtypes == [("id", "int"), ("tag", "string")]
    tables.publish(spark.sql("SELECT 5000000000 AS id, 'z' AS tag"), name, cfg.tables_root, widen=True)
    assert spark.table(name).dtypes == [("id", "bigint"), ("tag", "string")]
    assert [tuple(r) for r in spark.table(name).collect()] == [(5_000_000_000, "z")]


def test_expire_keeps_what_is_in_use(spark, cfg, name):
    for n in range(4):
        tables.publish(spark.range(n), name, cfg.tables_root)
    assert len(tables.expire(spark, name, cfg.tables_root, keep=2)) == 1
    assert len(tables.expire(spark, name, cfg.tables_root, keep=0)) == 2
    assert tables.expire(spark, name, cfg.tables_root, keep=0) == []
    assert spark.table(name).count() == 3
    assert tables.expire(spark, f"{cfg.silver}.never", cfg.tables_root) == []


def test_staged_batch_goes_with_its_block(spark, cfg):
    with tables.staged(spark.range(3), cfg.staging_root) as batch:
        (path,) = {p.rpartition("/")[0] for p in batch.inputFiles()}
        assert tables.path_exists(spark, path) and batch.count() == 3
    assert not tables.path_exists(spark, path)


def test_empty_table(spark, cfg, name):
    tables.create(spark.range(0), name, cfg.tables_root)
    assert spark.table(name).count() == 0


def test_exists_and_require(spark, cfg, name):
    assert not tables.exists(spark, name)
    with pytest.raises(RuntimeError, match="things"):
        tables.require(spark, name)
    tables.create(spark.range(1), name, cfg.tables_root)
    tables.require(spark, name)
    tables.drop(spark, [name])
    assert not tables.exists(spark, name)


def test_gold_needs_its_sources(spark, cfg):
    with pytest.raises(RuntimeError, match="posts_hist, .*users_hist"):
        gold.build_gold(spark, cfg)


def test_staged_batch_is_computed_once(spark, cfg):
    drawn = tables.stage(spark.range(5).select(F.rand().alias("r")), cfg.staging_root)
    assert drawn.collect() == drawn.collect()


def test_refused_merge_leaves_the_table(spark, cfg):
    name = f"{cfg.silver}.merged"
    a = spark.createDataFrame([(1, "a"), (2, "b")], "Id long, v string")
    silver.merge_table(spark, cfg, name, a, ["Id"])
    twice = spark.createDataFrame([(2, "x"), (2, "y")], "Id long, v string")
    with pytest.raises(Exception, match="several incoming rows"):
        silver.merge_table(spark, cfg, name, twice, ["Id"])
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "a"), (2, "b")]
    out = silver.merge_table(spark, cfg, name, a.limit(1).withColumn("v", F.lit("new")), ["Id"])
    assert out.count() == 2


def test_register_refuses_a_second_time_and_adds_no_stamp(spark, cfg):
    users = fx.users(spark, SF_SMALL)
    out = silver.register(spark, cfg, cfg.users_table, [users, users.select(*USER_COLUMNS_NARROW)])
    assert out.columns == users.columns
    assert out.count() == 2 * users.count()
    with pytest.raises(ValueError):
        silver.register(spark, cfg, cfg.users_table, [users])


def test_users_upsert_is_repeatable(spark, cfg):
    first = [parse_dates(fx.users(spark, SF_SMALL))]
    silver.build_users(spark, cfg, first, AT)
    after = silver.build_users(spark, cfg, first, LATER)
    assert after.count() == first[0].count()
    assert [r[0] for r in after.select("fecha_cargue").distinct().collect()] == [LATER]


def test_year_overwrite_leaves_other_years(spark, tmp_path):
    root = str(tmp_path / "users")
    users = fx.users(spark, SF_SMALL)
    bronze.ingest_span(users, root, 1995, 2001)
    read = lambda y: files.read_entity(spark, f"{root}/year={y}")
    old = {y: sorted(map(tuple, read(y).collect()), key=str) for y in range(1995, 2002)}
    assert all(old.values())
    bronze.ingest_users(users, root, 1998, limit=3)
    assert read(1998).count() == 3
    bronze.ingest_span(users, root, 2000, 2001)
    for y in (1995, 1996, 1997, 1999, 2000, 2001):
        assert sorted(map(tuple, read(y).collect()), key=str) == old[y]


def test_bronze_files_are_snappy_and_listed(spark, tmp_path):
    root = str(tmp_path / "posts")
    posts = fx.posts(spark, SF_SMALL)
    path = bronze.ingest_posts(posts, root, 2020, limit=7)
    assert path.endswith("year=2020")
    listed = files.rows_per_file(spark, [path]).collect()
    assert sum(r.n_rows for r in listed) == 7
    assert all("year=2020/part-" in r.file_path for r in listed)
    assert all(r.file_path.endswith(".snappy.parquet") for r in listed)


def test_years_with_different_columns(spark, tmp_path):
    users = fx.users(spark, SF_SMALL)
    root = str(tmp_path / "users")
    bronze.ingest_users(users, root, 1997)
    bronze.ingest_users(users, root, 1998, columns=USER_COLUMNS_NARROW)
    raw = files.read_years(spark, root + "/year={year}", [1997, 1998])
    assert [len(df.columns) for df in raw] == [len(users.columns), 3]
    fitted = files.read_years(spark, root + "/year={year}", [1997, 1998], USERS)
    assert all(df.columns == USERS.fieldNames() for df in fitted)


def test_yearly_source_path():
    assert files.yearly_path("s3a://raw/posts/{year}.parquet", 2021) == "s3a://raw/posts/2021.parquet"


def test_pipeline_twice_adds_no_rows(spark, cfg):
    run = Config(root=cfg.root, years=tuple(range(1995, 2002)), silver=cfg.silver, gold=cfg.gold)
    bronze.ingest_span(fx.posts(spark, SF_SMALL), run.bronze("posts"), 1995, 2001)
    bronze.ingest_span(fx.users(spark, SF_SMALL), run.bronze("users"), 1995, 2001)
    first = pipeline.build_layers(spark, run, AT, date(2023, 1, 1)).drop("fecha_cargue")
    second = pipeline.build_layers(spark, run, LATER, date(2024, 1, 1))
    assert [r[0] for r in second.select("fecha_cargue").distinct().collect()] == [date(2024, 1, 1)]
    assert first.exceptAll(second.drop("fecha_cargue")).count() == 0
    assert second.count() == first.count()


def test_reports(spark, cfg):
    counts = row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert sorted(map(tuple, counts.collect())) == [("a", 3), ("b", 0)]
    tables.create_namespace(spark, cfg.silver, cfg.tables_root)
    tables.create(spark.range(4), cfg.users_table, cfg.tables_root)
    report = {r.table_name: r for r in table_report(spark, [cfg.users_table, "nowhere.t"]).collect()}
    assert (report[cfg.users_table].n_rows, report[cfg.users_table].error) == (4, None)
    assert report["nowhere.t"].n_rows is None and "NOT_FOUND" in report["nowhere.t"].error


def test_config_from_settings():
    made = Config.from_env({"WAREHOUSE": "/w/", "BRONZE_YEAR": "2021", "BRONZE_LIMIT": "20000"})
    assert (made.root, made.years, made.limit_posts, made.limit_users) == ("/w", (2021,), 20000, 20000)
    other = Config.from_env({"WAREHOUSE": "/w", "BRONZE_LIMIT_USERS": "0"})
    assert (other.years, other.limit_posts, other.limit_users) == ((2020, 2021), None, 0)
    assert other.gold_table == "gold.post_counts_by_user"


def test_session(spark):
    session = build_session("test", Config(root="/w", session={"spark.sql.shuffle.partitions": "8"}))
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session.conf.get("spark.sql.shuffle.partitions") == "8"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")

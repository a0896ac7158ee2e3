"""Tables cut by ranges of keys of any type: same rows as the pure upsert, untouched ranges left alone."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from layerloom.operators.upsert import upsert
from layerloom.plans import silver
from layerloom.sources import tables

N = 400


@pytest.fixture
def name(spark, cfg):
    tables.create_namespace(spark, cfg.silver, cfg.tables_root)
    yield f"{cfg.silver}.kept"
    tables.drop(spark, [f"{cfg.silver}.kept"])


KINDS = {
    "date": ("date", lambda i: dt.date(2020, 1, 1) + dt.timedelta(days=i), 10),
    "before 1970": ("date", lambda i: dt.date(1969, 6, 1) + dt.timedelta(days=i), 10),
    "timestamp": ("timestamp", lambda i: dt.datetime(1969, 12, 31, 23) + dt.timedelta(seconds=i, microseconds=i), 10),
    "zoneless": ("timestamp_ntz", lambda i: dt.datetime(2020, 1, 1) + dt.timedelta(seconds=i), 2**27),
    "decimal": ("decimal(12,2)", lambda i: Decimal(i) / 4, 10),
    "text": ("string", lambda i: f"ключ {i}", 2**27),
    "binary": ("binary", lambda i: bytearray(str(i), "ascii"), 2**27),
    "double": ("double", lambda i: float(i) / 8, 2**27),
    "boolean": ("boolean", lambda i: i % 2 == 0, 2**27),
}


def rows(spark, kind, ids, v):
    type_, of, _ = KINDS[kind]
    return spark.createDataFrame([(of(i), i, v) for i in ids], f"k {type_}, n long, v string")


def plain(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("kind", KINDS)
def test_as_the_pure_upsert(spark, cfg, name, kind):
    """Nulls, repeated keys on both sides, keys that are new and keys that stay."""
    type_, _, width = KINDS[kind]
    null = spark.createDataFrame([(None, -1, "null")], f"k {type_}, n long, v string")
    old = rows(spark, kind, [*range(N), 3, 3], "old").unionByName(null)
    new = rows(spark, kind, [3, 5, 5, N + 7], "new").unionByName(null)
    want = plain(upsert(old, new, ["k"]))
    made = replace(cfg, range_width=width)
    silver.upsert_table(spark, made, name, old, ["k"])
    before = tables._range_locations(spark, name)
    got = silver.upsert_table(spark, made, name, new, ["k"])
    assert plain(got) == want
    after = tables._range_locations(spark, name)
    left = [r for r in before if before[r] == after[r]]
    # A key of the batch is in one range, and so are the null ones.
    assert len(left) >= len(before) - 4 and (len(before) > 8 or kind == "boolean")


def test_zero_and_nan_keys(spark, cfg, name):
    """Spark joins -0.0 with 0.0 and NaN with NaN, so they share a range."""
    make = lambda v: spark.sql(f"SELECT explode(array(0D, double('NaN'), 1D)) AS k, '{v}' AS v")
    old = make("old").unionByName(spark.sql("SELECT -0D AS k, 'minus' AS v"))
    new = spark.sql("SELECT explode(array(-0D, double('NaN'))) AS k, 'new' AS v")
    made = replace(cfg, range_width=2**20)
    silver.upsert_table(spark, made, name, old, ["k"])
    got = silver.upsert_table(spark, made, name, new, ["k"])
    assert sorted(r.v for r in got.collect()) == ["new", "new", "old"]


def test_several_columns_and_a_smaller_type(spark, cfg, name):
    old = spark.range(N).selectExpr("id AS a", "concat('t', id % 3) AS b", "'old' AS v")
    old = old.unionByName(spark.sql("SELECT 1L AS a, CAST(NULL AS STRING) AS b, 'old' AS v"))
    new = spark.range(5, 9).selectExpr("int(id) AS a", "concat('t', id % 3) AS b", "'new' AS v")
    new = new.unionByName(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, 'new' AS v"))
    made = replace(cfg, range_rows=20)
    silver.upsert_table(spark, made, name, old, ["a", "b"])
    key, width = tables.ranges_of(spark, name)
    assert key == ("a", "b") and 2**31 / width > 15
    before = tables._range_locations(spark, name)
    got = silver.upsert_table(spark, cfg, name, new, ["b", "a"])
    assert plain(got) == plain(upsert(old, new, ["a", "b"]).select("a", "b", "v"))
    after = tables._range_locations(spark, name)
    assert sum(before[r] != after[r] for r in before) <= 5


def test_untouched_files_are_neither_read_nor_written(spark, cfg, name):
    tables.create_ranges(rows(spark, "text", range(N), "old"), name, cfg.tables_root, "k", 2**27)
    every, read = set(spark.table(name).inputFiles()), []
    places = tables._range_locations(spark, name)

    def combine(existing, incoming, keys):
        read.extend(existing.inputFiles())
        return upsert(existing, incoming, keys)

    tables.upsert_ranges(rows(spark, "text", [11], "new"), name, cfg.tables_root, combine)
    now = set(spark.table(name).inputFiles())
    moved = [r for r, p in tables._range_locations(spark, name).items() if p != places[r]]
    assert len(moved) == 1 and set(read) == every - now
    assert all(f"key_range={moved[0]}" in f for f in read) and 0 < len(read) < len(every)
    assert len(now - every) >= 1 and every & now == every - set(read)


@pytest.mark.parametrize("combine", [silver.upsert_table, silver.merge_table])
def test_a_table_in_one_piece_is_cut_by_the_next_write(spark, cfg, name, combine):
    old, new = rows(spark, "text", range(N), "old"), rows(spark, "text", [1, N], "new")
    combine(spark, cfg, name, old, ["k"])
    assert tables.ranges_of(spark, name) is None
    got = combine(spark, replace(cfg, range_rows=40), name, new, ["k"])
    assert plain(got) == plain(upsert(old, new, ["k"])) and got.columns == ["k", "n", "v"]
    assert tables.ranges_of(spark, name)[0] == "k" and len(tables._range_locations(spark, name)) > 5
    assert tables.version(spark, name) == 2
    before = tables._range_locations(spark, name)
    combine(spark, cfg, name, rows(spark, "text", [2], "more"), ["k"])
    after = tables._range_locations(spark, name)
    assert sum(before[r] != after[r] for r in before) == 1


def test_publish_cuts_a_table(spark, cfg, name):
    tables.publish(rows(spark, "date", range(N), "old"), name, cfg.tables_root)
    grown = spark.table(name).withColumn("more", F.lit(1))
    tables.publish(grown, name, cfg.tables_root, key="k", width=100)
    assert tables.ranges_of(spark, name) == ("k", 100) and silver.read_table(spark, name).count() == N
    assert silver.read_table(spark, name).columns == ["k", "n", "v", "more"]


def test_upsert_by_another_key_than_the_ranges(spark, cfg, name):
    """The ranges say nothing about such a key, so the table is read whole, and stays cut."""
    old = rows(spark, "date", range(N), "old")
    silver.upsert_table(spark, replace(cfg, range_width=50), name, old, ["k"])
    new = old.where("n in (3, 390)").withColumn("k", F.date_add("k", 100)).withColumn("v", F.lit("new"))
    got = silver.upsert_table(spark, cfg, name, new, ["n"])
    assert plain(got) == plain(upsert(old, new, ["n"]))
    assert tables.ranges_of(spark, name) == ("k", 50)
    out = silver.upsert_table(spark, cfg, name, got.where("n = 3").withColumn("v", F.lit("last")), ["k"])
    assert {r.v for r in out.where("n = 3").collect()} == {"last"}


def test_a_batch_with_another_type_of_key_is_refused(spark, cfg, name):
    tables.create_ranges(rows(spark, "date", range(20), "old"), name, cfg.tables_root, "k", 5)
    before = tables._range_locations(spark, name)
    with pytest.raises(ValueError, match="types of: k"):
        tables.upsert_ranges(rows(spark, "timestamp", [1], "new"), name, cfg.tables_root, upsert)
    assert tables._range_locations(spark, name) == before


def test_widths_from_rows(spark):
    assert tables.width_for(rows(spark, "date", range(100), "a"), "k", 10) == 10
    assert tables.width_for(rows(spark, "decimal", range(0, 400, 4), "a"), "k", 10) == 10
    assert 2**31 / 15 < tables.width_for(rows(spark, "text", range(N), "a"), "k", N // 10) < 2**31 / 7


def test_nested_keys_have_no_ranges(spark, cfg, name):
    nested = spark.sql("SELECT struct(1 AS a) AS k, 2 AS v")
    with pytest.raises(ValueError, match="nested"):
        tables.create_ranges(nested, name, cfg.tables_root, "k", 5)
    assert not tables.exists(spark, name)

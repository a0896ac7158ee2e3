import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from layerloom.operators import skew
from layerloom.operators.upsert import anti_unchanged, merge_into, upsert

WIDE, NARROW = "k long, name string, n int", "k long, name string"
KNOWN = [(1, "a", 10), (2, "b", 20), (None, "n", 5)]
BATCH = [(2, "B"), (3, "C"), (3, "C2"), (None, "N")]
AFTER = [(1, "a", 10), (2, "B", None), (3, "C", None), (3, "C2", None), (None, "n", 5), (None, "N", None)]


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def frames(spark, known=KNOWN, batch=BATCH):
    return spark.createDataFrame(known, WIDE), spark.createDataFrame(batch, NARROW)


def test_rows_are_replaced_whole_nulls_and_duplicates_stay(spark):
    known, batch = frames(spark)
    assert rows(upsert(known, batch, ["k"])) == Counter(AFTER)


def test_column_order_of_the_target_stays(spark):
    known = spark.createDataFrame([("a", 1)], "name string, k long")
    batch = spark.createDataFrame([(1, "b")], "k long, name string")
    assert anti_unchanged(known, batch, ["k"]).columns == ["name", "k"]
    assert rows(upsert(known, batch, ["k"])) == Counter([("b", 1)])


def test_column_new_in_the_batch_is_added(spark):
    known = spark.createDataFrame([(1, "a"), (2, "b")], NARROW)
    batch = spark.createDataFrame([(2, "B", 7)], WIDE)
    assert rows(upsert(known, batch, ["k"])) == Counter([(1, "a", None), (2, "B", 7)])


def test_keys_that_stop_appearing_stay(spark):
    known, _ = frames(spark)
    assert rows(upsert(known, known.limit(0), ["k"])) == Counter(KNOWN)


def test_null_keys_pile_up(spark):
    known, _ = frames(spark)
    again = upsert(upsert(known, known, ["k"]), known, ["k"])
    assert again.where("k IS NULL").count() == 3
    assert again.where("k IS NOT NULL").count() == 2


def test_two_column_key(spark):
    known = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, None, "c")], "k int, j int, v string")
    batch = spark.createDataFrame([(1, 2, "B"), (1, None, "C")], "k int, j int, v string")
    want = Counter([(1, 1, "a"), (1, 2, "B"), (1, None, "c"), (1, None, "C")])
    assert rows(upsert(known, batch, ["k", "j"])) == want


def test_merge_refuses_two_rows_for_one_target(spark):
    known, _ = frames(spark)
    batch = spark.createDataFrame([(2, "B", 1), (2, "B2", 1)], WIDE)
    with pytest.raises(SparkRuntimeException, match="several incoming rows for key 2"):
        merge_into(known, batch, ["k"]).collect()


def test_merge_inserts_unmatched_duplicates_unless_strict(spark):
    known, batch = frames(spark)
    whole = batch.withColumn("n", F.lit(None).cast("int"))
    assert rows(merge_into(known, whole, ["k"])) == Counter(AFTER)
    with pytest.raises(SparkRuntimeException, match="several incoming rows for key 3"):
        merge_into(known, whole, ["k"], strict=True).collect()


def test_merge_takes_several_null_keys(spark):
    known, _ = frames(spark)
    batch = spark.createDataFrame([(None, "x", 1), (None, "y", 1)], WIDE)
    assert merge_into(known, batch, ["k"], strict=True).count() == 5


def test_merge_needs_every_column_of_the_table(spark):
    known, batch = frames(spark)
    with pytest.raises(ValueError, match="lacks columns of the table: n"):
        merge_into(known, batch, ["k"])
    renamed = batch.withColumn("N", F.lit(1))
    assert merge_into(known, renamed, ["k"]).count() == len(AFTER)


KEYS = {
    "ntz": ("timestamp_ntz", [datetime(2020, 1, d, 2, 30) for d in range(1, 6)]),
    "date": ("date", [date(2020, 1, d) for d in range(1, 6)]),
    "decimal": ("decimal(20,3)", [Decimal(d) / 8 for d in range(1, 6)]),
    "text": ("string", list("abcde")),
    "binary": ("binary", [bytearray([0, d]) for d in range(5)]),
}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_any_key_type_in_any_zone(spark, kind, zone, monkeypatch):
    """The same rows whatever the clocks of the machine and the session say."""
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        type_, keys = KEYS[kind]
        known = spark.createDataFrame([(k, "old") for k in keys], f"k {type_}, v string")
        batch = spark.createDataFrame([(k, "new") for k in keys[1:4]], f"k {type_}, v string")
        for combine in (upsert, merge_into):
            found = [(r.k, r.v) for r in combine(known, batch, ["k"]).orderBy("k").collect()]
            assert found == [(k, "new" if k in keys[1:4] else "old") for k in keys]
        twice = batch.unionAll(batch)
        with pytest.raises(SparkRuntimeException, match="several incoming rows"):
            merge_into(known, twice, ["k"]).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        monkeypatch.undo()
        time.tzset()


keyed = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 3)), max_size=12)


def reference_upsert(known, batch):
    replaced = {k for k, _ in batch if k is not None}
    return Counter([r for r in known if r[0] is None or r[0] not in replaced] + batch)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(known=keyed, batch=keyed)
def test_upsert_against_plain_python(spark, known, batch):
    a = spark.createDataFrame(known, "k long, v long").repartition(3)
    b = spark.createDataFrame(batch, "k long, v long")
    want = reference_upsert(known, batch)
    assert rows(upsert(a, b, ["k"])) == want
    unique = list({k: (k, v) for k, v in batch}.values())
    once = spark.createDataFrame(unique, "k long, v long")
    assert rows(merge_into(a, once, ["k"], strict=True)) == reference_upsert(known, unique)


def test_second_run_with_unique_keys_changes_nothing(spark):
    known = spark.createDataFrame([(1, "a"), (2, "b")], NARROW)
    batch = spark.createDataFrame([(2, "B"), (3, "C")], NARROW)
    once = upsert(known, batch, ["k"])
    assert rows(upsert(once, batch, ["k"])) == rows(once)


def salted_rows(right, key, rows_per_split):
    """Rows of each (key, salt), as ``spread_left_join`` deals them."""
    placed = right.withColumn(skew.PLACE, F.monotonically_increasing_id())
    hot = skew.split_counts(right, key, rows_per_split)
    salt = F.pmod(F.xxhash64(*right.columns, skew.PLACE), F.coalesce(F.col(skew.SPLITS), F.lit(1)))
    return placed.join(hot, key, "left").withColumn(skew.SALT, salt).groupBy(key, skew.SALT).count()


def test_thousands_of_hot_keys_are_all_split(spark):
    right = spark.range(100_000).select((F.col("id") % 5_000).alias("k"), "id")
    hot = skew.split_counts(right, "k", rows_per_split=5)
    assert hot.count() == 5_000 and hot.agg(F.min(skew.SPLITS)).first()[0] == 4
    assert salted_rows(right, "k", 5).groupBy("k").count().agg(F.min("count")).first()[0] > 1


def test_equal_rows_of_one_input_task_are_spread(spark):
    right = spark.range(5_000, numPartitions=1).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    sizes = [r["count"] for r in salted_rows(right, "k", 1_000).collect()]
    assert len(sizes) == 5 and max(sizes) < 1_300


def test_null_is_no_hot_key(spark):
    df = spark.createDataFrame([(None,)] * 9 + [(1,)], "k long")
    assert skew.split_counts(df, "k", 2).count() == 0
    assert skew.split_counts(df.limit(0), "k", 2).count() == 0


sided = st.lists(st.one_of(st.none(), st.integers(0, 5)), max_size=14)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left=sided, right=sided, per_split=st.integers(1, 3))
def test_spread_left_join_against_the_plain_one(spark, left, right, per_split):
    a = spark.createDataFrame([(k, i) for i, k in enumerate(left)], "a long, i long")
    b = spark.createDataFrame([(k, "same") for k in right], "b long, j string").repartition(3)
    plain = a.join(b, a["a"] == b["b"], "left")
    assert rows(skew.spread_left_join(a, b, "a", "b", per_split)) == rows(plain)

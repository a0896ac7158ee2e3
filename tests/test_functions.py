from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerloom.functions.casts import conform, tolerant_int, tolerant_timestamp
from layerloom.functions.dates import drop_null_dates, filter_year, parse_dates, with_year
from layerloom.functions.stamps import stamp_day, stamp_time
from layerloom.operators import limits
from layerloom.operators.align import union_aligned
from layerloom.operators.limits import first_rows, preview, top_rows
from layerloom.operators.metrics import owner_metrics
from layerloom.schemas import POSTS, USERS, USERS_NARROW


def values(df, column):
    return [r[column] for r in df.collect()]


@pytest.mark.parametrize(
    "text, number",
    [
        ("12", 12),
        (" 12 ", 12),
        ("-7.9", -7),
        ("3.7", 3),
        ("101.0", 101),
        ("3.", 3),
        (".5", 0),
        ("x", None),
        ("", None),
        ("1e3", None),
        ("3.7x", None),
        ("3 .7", None),
        ("99999999999", None),
        (None, None),
    ],
)
def test_tolerant_int(spark, text, number):
    df = spark.createDataFrame([(text,)], "v string")
    assert values(df.select(tolerant_int(F.col("v")).alias("v")), "v") == [number]


def test_tolerant_int_agrees_with_casts_outside_ansi(spark):
    texts = ["12", "-3", "+4", "3.7", "101.0", ".5", "-.5", "x", "", " 8 ", "1e3", "2147483648", "7.", "9x"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    ours = values(df.select(tolerant_int(F.col("v")).alias("v")), "v")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert ours == values(df.select(F.col("v").cast("int").alias("v")), "v")
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_tolerant_int_takes_numbers(spark):
    df = spark.createDataFrame([(101.0, 5), (None, 6)], "d double, i int")
    out = df.select(tolerant_int(F.col("d")).alias("d"), tolerant_int(F.col("i")).alias("i"))
    assert [tuple(r) for r in out.collect()] == [(101, 5), (None, 6)]


def test_tolerant_timestamp(spark):
    df = spark.createDataFrame([("2021-01-02 03:04:05",), ("bad",), ("2021-02-03",), (None,)], "v string")
    assert values(df.select(tolerant_timestamp(F.col("v")).alias("v")), "v") == [
        datetime(2021, 1, 2, 3, 4, 5), None, datetime(2021, 2, 3), None,
    ]


def test_year_edges(spark):
    df = parse_dates(
        spark.createDataFrame(
            [(1, "2020-12-31 23:59:59.999999"), (2, "2021-01-01 00:00:00"), (3, "bad")],
            "Id long, CreationDate string",
        )
    )
    assert values(filter_year(df, 2020), "Id") == [1]
    assert values(filter_year(df, 2021), "Id") == [2]
    assert values(drop_null_dates(df), "Id") == [1, 2]
    assert values(with_year(df), "year") == [2020, 2021, None]


def test_year_filter_keeps_clock_of_other_zones_out(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        df = parse_dates(
            spark.createDataFrame([(1, "2021-01-01 00:00:00")], "Id long, CreationDate string")
        )
        assert filter_year(df, 2021).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_stamps(spark):
    df = spark.range(1)
    assert values(stamp_time(df, datetime(2024, 5, 6, 7, 8, 9)), "fecha_cargue") == [datetime(2024, 5, 6, 7, 8, 9)]
    assert values(stamp_day(df, date(2024, 5, 6)), "fecha_cargue") == [date(2024, 5, 6)]
    assert stamp_time(df).schema["fecha_cargue"].dataType == T.TimestampType()
    assert stamp_day(df).schema["fecha_cargue"].dataType == T.DateType()
    twice = stamp_time(spark.range(100).repartition(4)).select("fecha_cargue").distinct()
    assert twice.count() == 1


def test_conform_fills_casts_and_drops(spark):
    df = spark.createDataFrame([("7", "12", "x")], "Id string, Views string, Extra string")
    row = conform(df, USERS).first()
    assert (row.Id, row.Views, row.DisplayName) == (7, 12, None)
    assert conform(df, USERS).columns == USERS.fieldNames()
    assert conform(df, USERS, keep_extra=True).columns == [*USERS.fieldNames(), "Extra"]


def test_conform_keeps_columns_that_already_fit(spark):
    df = spark.createDataFrame([(1, None, "3")], USERS_NARROW)
    assert conform(df, USERS_NARROW, keep_extra=True).collect() == df.collect()


@pytest.mark.parametrize("kind, value", [
    ("string", "seven"), ("string", "12.5"), ("string", ""), ("double", 3.25), ("double", float("nan")),
    ("bigint", 3_000_000_000), ("string", "3000000000"), ("double", 3e9), ("boolean", True),
])
def test_conform_fails_on_a_number_it_cannot_hold(spark, kind, value):
    df = spark.createDataFrame([(1, value)], f"Id long, Views {kind}")
    with pytest.raises(Exception, match="Views: not a int"):
        conform(df, USERS).collect()


@pytest.mark.parametrize("kind, value, number", [
    ("string", "12.0", 12), ("string", " -7 ", -7), ("string", "5.", 5), ("double", 12.0, 12), ("double", -1e7, -10_000_000),
    ("bigint", 2**31 - 1, 2**31 - 1), ("smallint", 3, 3), ("string", None, None), ("decimal(10,2)", 4, 4),
])
def test_conform_reads_whole_numbers(spark, kind, value, number):
    df = spark.createDataFrame([(1, None if value is None else str(value))], "Id long, v string")
    df = df.selectExpr("Id", f"CAST(v AS {kind}) AS Views")
    assert conform(df, USERS).first().Views == number


def test_conform_matches_names_as_spark_does(spark):
    df = spark.createDataFrame([(7, "x")], "ID long, displayname string")
    row = conform(df, USERS, keep_extra=True).first()
    assert (row.Id, row.DisplayName) == (7, "x") and len(row) == len(USERS)


def test_conform_needs_required_columns(spark):
    df = spark.createDataFrame([("x",)], "DisplayName string")
    with pytest.raises(ValueError, match="required columns are missing: Id"):
        conform(df, USERS)


def test_conform_tolerates_only_named_dates(spark):
    df = spark.createDataFrame([(1, "no date", "no date")], "Id long, CreationDate string, LastActivityDate string")
    with pytest.raises(Exception, match="LastActivityDate: not a timestamp_ntz"):
        conform(df, POSTS).collect()
    assert conform(df.drop("LastActivityDate"), POSTS).first().CreationDate is None


def test_conform_fails_on_unreadable_key(spark):
    df = spark.createDataFrame([("seven",)], "Id string")
    with pytest.raises(Exception, match="Id: not a bigint"):
        conform(df, USERS).collect()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_zoned_text_is_read_in_utc(spark, zone):
    texts = {
        "2019-12-31T23:30:00-02:00": datetime(2020, 1, 1, 1, 30), "2020-01-01 02:00:00+05:00": datetime(2019, 12, 31, 21),
        "2020-01-01T02:00:00Z": datetime(2020, 1, 1, 2), "2020-01-01T02:00:00.5": datetime(2020, 1, 1, 2, 0, 0, 500_000),
        "2020-01-01": datetime(2020, 1, 1), "2020-01-01 02:00:00 Europe/Paris": datetime(2020, 1, 1, 1), "x": None,
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(list(enumerate(texts)), "i long, CreationDate string")
        found = parse_dates(df).orderBy("i").collect()
        assert [r.CreationDate for r in found] == list(texts.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_union_fills_missing_columns_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "Id long, DisplayName string")
    b = spark.createDataFrame([(1,), (2,)], "Id long")
    rows = sorted(union_aligned([a, b, b]).collect(), key=str)
    assert [tuple(r) for r in rows] == [(1, "x"), (1, None), (1, None), (2, None), (2, None)]


def test_union_of_number_and_text_needs_the_schema(spark):
    a = spark.createDataFrame([(1, 10)], "Id long, Reputation int")
    b = spark.createDataFrame([(2, "n/a")], "Id long, Reputation string")
    out = union_aligned([a, b], USERS)
    assert sorted(values(out, "Reputation")) == ["10", "n/a"]


@pytest.mark.parametrize("limit, ids", [(None, [1, 2, 3]), (0, []), (2, [1, 2])])
def test_row_cap(spark, limit, ids):
    df = spark.createDataFrame([(3,), (1,), (2,)], "Id long")
    assert sorted(values(first_rows(df, limit, "Id"), "Id")) == ids


@pytest.mark.parametrize("limit", [0, 1, 3, 64, 65, 100, 1000])
def test_row_cap_over_buckets(spark, monkeypatch, limit):
    """Caps that fall inside a bucket, on its edge and past the end, per year and in all."""
    monkeypatch.setattr(limits, "BUCKET", 16)
    ids = [None, None, -40, -1, *range(0, 300, 3)]
    rows = [(i, year) for year in (2020, 2021) for i in (ids if year == 2020 else ids[:50])]
    df = spark.createDataFrame(rows, "Id long, year int").repartition(4)
    order = lambda r: (r[0] is not None, r[0] or 0)
    for year, mine in ((2020, ids), (2021, ids[:50])):
        found = limits.first_rows(df, limit, "Id", "year").where(f"year = {year}").collect()
        assert sorted([r.Id for r in found], key=lambda i: (i is not None, i or 0)) == mine[:limit]
    every = [tuple(r) for r in limits.first_rows(df, limit, "Id").collect()]
    want = sorted(rows, key=order)[:limit]
    assert sorted(r[0] is None or r[0] for r in every) == sorted(r[0] is None or r[0] for r in want)


def test_top_rows_breaks_ties_by_key(spark):
    df = spark.createDataFrame([(3, 5), (1, 5), (2, 9)], "k long, n long")
    assert values(top_rows(df, "n", 2, "k"), "k") == [2, 1]
    assert preview(df, 2).count() == 2


def posts(spark, rows):
    made = spark.createDataFrame(rows, "Id long, OwnerUserId long, PostTypeId int, Score int")
    return conform(made, POSTS)


def test_all_null_group_sums_to_null(spark):
    row = owner_metrics(posts(spark, [(1, 7, 1, None), (2, 7, 2, None)])).first()
    assert (row.total_posts, row.total_score, row.score_promedio) == (2, None, None)


def test_metrics_of_an_owner(spark):
    rows = [(1, 7, 1, 1), (2, 7, 2, None), (3, 7, 5, 3), (4, None, 1, 100), (5, 8, None, 0)]
    out = {r.OwnerUserId: r for r in owner_metrics(posts(spark, rows)).collect()}
    assert set(out) == {7, 8}
    assert (out[7].total_posts, out[7].total_preguntas, out[7].total_respuestas) == (3, 1, 1)
    assert (out[7].total_score, out[7].score_promedio) == (4, 2.0)
    assert (out[8].total_preguntas, out[8].total_respuestas) == (0, 0)


def test_mean_rounds_half_up(spark):
    rows = [(i, 7, 1, 1 if i == 0 else 0) for i in range(8)]  # mean 0.125
    assert owner_metrics(posts(spark, rows)).first().score_promedio == 0.13

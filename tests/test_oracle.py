"""Every registered query against its SQL in another engine, over the whole test tables."""

import duckdb
import pytest
from given import SF_CHECK

import __spark_entry__ as entry

QUERIES, ORACLES = entry._own_queries(), entry._own_oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in entry.GIVEN_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_CHECK}/{name}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


TYPES = {
    "BIGINT": {"bigint"},
    "INTEGER": {"int"},
    "DOUBLE": {"double"},
    "VARCHAR": {"string"},
    "BOOLEAN": {"boolean"},
    "DATE": {"date"},
    "TIMESTAMP": {"timestamp", "timestamp_ntz"},
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(name, spark, duck):
    got = QUERIES[name](spark, SF_CHECK)
    rows = [tuple(r) for r in got.collect()]
    found = duck.execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert sorted(got.columns) == sorted(columns)
    kinds = dict(got.dtypes)
    for column, kind, *_ in found.description:
        assert kinds[column] in TYPES[str(kind)], column
    want = [tuple(r) for r in found.fetchall()]
    assert rows
    assert ordered(got.columns, rows) == ordered(columns, want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0

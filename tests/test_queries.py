"""Every query against its SQL on the given tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{file}'")
    return connection


def value(v):
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, bool) or v is None or not isinstance(v, (int, float)):
        return v
    return None if math.isnan(v) else float(v) + 0.0


def table(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    names = [columns[i] for i in order]
    return names, sorted((tuple(value(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE[name])
    expected = table([c[0] for c in cursor.description], cursor.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_model_query_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:3] == ["p_type", "ship_month", "level"] and df.count() > 0


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(QUERIES)

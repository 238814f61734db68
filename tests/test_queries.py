"""Every registered query against DuckDB on the same tables."""

import datetime
import decimal
import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from checks import merging, reading, writing
from checks.reading import TABLES

QUERIES = {**writing.QUERIES, **reading.QUERIES, **merging.QUERIES}
ORACLE = {**writing.ORACLE, **reading.ORACLE, **merging.ORACLE}

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        return "nan" if math.isnan(value) else round(float(value), 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(t[i]) for i in order) for t in tuples), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    con = duck.execute(ORACLE[name])
    columns = [d[0] for d in con.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = rows(columns, con.fetchall())
    found = rows(ours.columns, [tuple(r) for r in ours.collect()])
    assert len(found) == len(expected) > 0
    assert found == expected


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["ano", "mes", "o_orderpriority", "n_orders", "revenue"]
    assert df.count() > 0

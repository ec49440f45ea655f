"""Every registered query against its SQL on the smallest tables."""

import datetime
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tallyforge.catalog import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v + 0.0
    return v.isoformat() if isinstance(v, datetime.datetime) else v


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    found = as_bag(df.columns, df.collect())
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert found == as_bag(columns, cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.items() <= entry.queries().items() and SQL.items() <= entry.oracle_sql().items()

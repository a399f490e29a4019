import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from scanforge.catalog.queries import ORACLE_SQL, QUERIES
from tools.check_queries import normal

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = normal(QUERIES[name](spark, SF).toPandas())
    want = normal(duck.execute(ORACLE_SQL[name]).df())
    assert list(got.columns) == list(want.columns) and len(got) == len(want) > 0
    for c in got.columns:
        a, b = got[c].to_numpy(), want[c].to_numpy()
        assert np.all((a == b) | ((a != a) & (b != b))), c


def test_entry(spark):
    assert entry.entry(spark).count() > 0

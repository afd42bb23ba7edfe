"""Every registered query runs, and gives the rows of its SQL where there is one."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import TABLES, compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(name, spark, duck):
    df = entry.queries()[name](spark, FOLDER)
    found = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert found
        return
    res = duck.execute(sql)
    cols = [d[0] for d in res.description]
    assert compare(found, df.columns, res.fetchall(), cols) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 6

"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check_queries import TABLES, compare

FOLDER = "/root/testdata/sf0.001"
SQLS = oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, db, name):
    got = queries()[name](spark, FOLDER).toPandas()
    if name in SQLS:
        assert compare(got, db.execute(SQLS[name]).fetchdf()) == ""
    else:
        assert len(got) > 0


def test_entry(spark):
    assert entry(spark).count() == 3


def test_every_sql_has_a_query():
    assert set(SQLS) <= set(queries())

"""Every catalog query against its DuckDB statement at sf0.001."""

import duckdb
import pytest
from check_oracle import TABLES, digest
from conftest import SF_SMALL

import __spark_entry__ as entry
from tidemark import catalog, oracle

SQL = oracle.oracle_sql()
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(SQL) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(SQL[name]).df()
    c1, r1, h1 = digest(got)
    c2, r2, h2 = digest(want)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert h1 == h2, sorted(set(r1) ^ set(r2))[:5]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0


@pytest.mark.parametrize("name", ["log_summary", "tag_history_changes", "partition_plan", "log_fold"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = entry.queries()[name](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert digest(got)[2] == digest(con.execute(SQL[name]).df())[2]

"""Every query that SQL can state, against DuckDB."""

import duckdb
import pytest
from check_oracle import TABLES, digest

from tidemark.llm import queries, sql

SF = "/root/testdata/sf0.001"
SQL = sql.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    got, want = queries.queries()[name](spark, SF).toPandas(), con.execute(SQL[name]).df()
    assert dict(got.dtypes) == dict(want.dtypes)
    assert digest(got)[1] == digest(want)[1]

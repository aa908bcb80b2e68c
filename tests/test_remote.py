"""A query text as a source."""

import pytest

from tidemark.sources import remote


def test_wrap_rules():
    assert remote.remote_text("dbo.T") == "SELECT * FROM dbo.T"
    assert remote.remote_text("select 1") == "select 1"
    assert remote.from_clause("select 1") == "(select 1)"
    assert remote.from_clause("dbo.T", server="[Far]") == "OPENQUERY([Far], 'SELECT * FROM dbo.T')"
    assert remote.from_clause("select 'x'", server="Far") == "OPENQUERY([Far], 'select ''x''')"
    assert not remote.is_remote("[Here]", local_name="Here")


def test_local_query_binds_frames(spark):
    df = spark.range(5)
    out = remote.remote_query(spark, "SELECT count(*) AS n FROM {t}", t=df).collect()
    assert out[0]["n"] == 5


def test_remote_needs_a_connection(spark):
    with pytest.raises(ValueError):
        remote.remote_query(spark, "dbo.T", server="Far")

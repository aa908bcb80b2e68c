"""The one-call-per-procedure facade."""

from helpers import FIRST_SCHEMA, TAG_SCHEMA, d

from tidemark import api
from tidemark.sources.warehouse import ParquetWarehouse
from tidemark.spec import TableSpec
from pyspark.sql import types as T


def test_facade_loads_logs_and_summarises(spark, scratch):
    rows = [(1, d("2020-01-01"), d("2021-01-01"), "I"), (1, d("2020-02-01"), d("2021-02-01"), "U")]
    feed = spark.createDataFrame(rows, TAG_SCHEMA)
    struct = T._parse_datatype_string(FIRST_SCHEMA)
    wh = ParquetWarehouse(
        spark, scratch, {("S_Tag", "T_Latest"): (TableSpec("T_Latest", ("k",)), struct)},
        views={("S", "T"): lambda s: feed},
    )
    wh.set_watermark("S_Tag", d("2030-01-01"))
    r = api.tag_latest(wh, ("S", "T"), ("S_Tag", "T_Latest"), date_to=d("2025-01-01"), now=d("2024-01-01"))
    assert r.window.date_to == d("2021-02-01")
    assert [tuple(x) for x in wh.target("S_Tag", "T_Latest").select("k", "LakeActionCode").collect()] == [(1, "U")]
    # an explicit replay from an old low bound changes nothing
    api.tag_latest(wh, ("S", "T"), ("S_Tag", "T_Latest"), date_from=d("1900-01-01"), date_to=d("2025-01-01"), now=d("2024-02-01"))
    assert wh.target("S_Tag", "T_Latest").count() == 1
    api.log_logging(wh, d("2025-01-01"), "manual", "Check", "Start", rows_processed=5)
    summary = {r["Procedure"]: r for r in api.log_summary_view(wh).collect()}
    assert set(summary) == {"S_Tag.T_Latest", "manual"}
    assert summary["S_Tag.T_Latest"]["Status"] == "Success"
    assert api.log_latest_view(wh, 1).count() == 1

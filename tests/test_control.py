"""Pair discovery by naming rule, drivers, failure isolation and report text."""

import pytest
from helpers import FIRST_SCHEMA, TAG_SCHEMA, d

from tidemark.plans import control
from tidemark.plans.pairs import discover_gold_pairs, discover_silver_pairs
from tidemark.sources.warehouse import FrameWarehouse
from tidemark.spec import TableSpec

REG = "schema_name string, object_name string, type string"


def registry(spark):
    return spark.createDataFrame(
        [
            ("Sales", "T", "U"),
            ("Sales_Tag", "T_Latest", "U"),
            ("Hr_Derived", "V", "V"),
            ("Hr_Tag", "V_History", "U"),
            ("Hr", "Lonely", "U"),               # a source without a target
            ("Ops", "W", "U"),
            ("Ops_Tag", "W_Latest", "V"),        # a target that is a view: no match
            ("Live", "Customer", "V"),
            ("Dimension", "Customer", "U"),
            ("Live", "X", "V"),
            ("Other", "X", "U"),                 # not a gold target schema
        ],
        REG,
    )


def test_silver_and_gold_naming_rules(spark):
    reg = registry(spark)
    latest = [tuple(r[1:5]) for r in discover_silver_pairs(reg, "latest").collect()]
    assert latest == [("Sales", "T", "Sales_Tag", "T_Latest")]
    hist = [tuple(r[1:5]) for r in discover_silver_pairs(reg, "history").collect()]
    assert hist == [("Hr_Derived", "V", "Hr_Tag", "V_History")]
    gold = [tuple(r[1:5]) for r in discover_gold_pairs(reg).collect()]
    assert gold == [("Live", "Customer", "Dimension", "Customer")]


def test_two_sources_for_one_target_are_flagged(spark):
    reg = registry(spark).union(spark.createDataFrame([("Sales_Derived", "T", "V")], REG))
    p = discover_silver_pairs(reg, "latest").collect()
    assert len(p) == 2 and all(r["n_sources"] == 2 for r in p)


def _feed(spark):
    rows = [(1, d("2020-01-01"), d("2021-01-01"), "I"), (2, d("2020-01-01"), d("2021-02-01"), "I")]
    return spark.createDataFrame(rows, TAG_SCHEMA)


def test_driver_isolates_failures_and_reports_them_together(spark):
    wh = FrameWarehouse(spark)
    for s in ("A", "B", "C"):
        wh.tables[(s, "T")] = _feed(spark)
        wh.tables[(s + "_Tag", "T_Latest")] = spark.createDataFrame([], FIRST_SCHEMA)
        wh.specs[(s + "_Tag", "T_Latest")] = TableSpec("T_Latest", ("k",))
        if s != "B":
            wh.tables[(s + "_Tag", "__high_watermark")] = spark.createDataFrame(
                [(d("2030-01-01"),)], "LakeTimestamp timestamp_ntz"
            )
    limit = d("2025-01-01")
    with pytest.raises(control.ControlFailed) as err:
        control.run_control("latest", wh, date_limit=limit, now=d("2024-01-01"))
    report = err.value.report
    assert [r.target for r in report.rows] == ["silver.A_Tag.T_Latest", "silver.B_Tag.T_Latest", "silver.C_Tag.T_Latest"]
    a, b, c = report.rows
    assert a.message == "" and a.date_from == d("1900-01-01") and a.date_to == d("2021-02-01")
    assert b.message == "no high-watermark table" and b.date_from is None and b.date_to == limit
    assert wh.tables[("A_Tag", "T_Latest")].count() == 2 and wh.tables[("B_Tag", "T_Latest")].count() == 0
    assert str(err.value) == (
        "The following table(s) failed Control.Latest processing:\r\n"
        "\n\tsilver.B_Tag.T_Latest : \tError = no high-watermark table"
    )
    # the step events of every target were logged, the failure included
    statuses = [(e[3], e[5]) for e in wh.events]
    assert ("B_Tag.T_Latest", "Failed") in statuses and ("A_Tag.T_Latest", "Success") in statuses


def test_dry_run_changes_nothing(spark):
    wh = FrameWarehouse(spark)
    wh.tables[("A", "T")] = _feed(spark)
    wh.tables[("A_Tag", "T_First")] = spark.createDataFrame([], FIRST_SCHEMA)
    wh.specs[("A_Tag", "T_First")] = TableSpec("T_First", ("k",))
    wh.tables[("A_Tag", "__high_watermark")] = spark.createDataFrame([(None,)], "LakeTimestamp timestamp_ntz")
    r = control.run_control("first", wh, date_limit=d("2025-01-01"), now=d("2024-01-01"), dry_run=True)
    # a NULL watermark value means 1900-01-01: nothing is in the window
    assert r.rows[0].date_to == d("1900-01-01") and wh.tables[("A_Tag", "T_First")].count() == 0


def test_spark_failure_text_equals_the_raised_one(spark):
    report = control.ControlReport("Control.Latest", [
        control.ReportRow(2, "silver.B_Tag.T_Latest", "boom"),
        control.ReportRow(1, "silver.A_Tag.T_Latest", ""),
        control.ReportRow(3, "silver.C_Tag.T_Latest", "bang"),
    ])
    ok = control.ControlReport("Control.First", [control.ReportRow(1, "silver.A_Tag.T_First", "")])
    rows = control.failure_frame(spark, [report, ok]).collect()
    assert [(r["Procedure"], r["Message"]) for r in rows] == [("Control.Latest", report.failure_message)]
    assert ok.failure_message is None

"""Partition planning rules on small boundary sets."""

from helpers import d

from tidemark.plans import partitions as pp


def values(spark, ts):
    return spark.createDataFrame([(d(t),) for t in ts], "Value timestamp_ntz")


def test_grain_inference(spark):
    daily = values(spark, ["2020-01-01", "2020-01-02", "2020-01-03", "9999-12-31"])
    assert pp.grain_stats(daily).first()["grain"] == "D"
    assert pp.grain_stats(values(spark, ["2020-01-01"])).first()["grain"] == "M"
    monthly = values(spark, ["2020-01-01", "2020-02-01", "2020-03-01"])
    assert pp.grain_stats(monthly).first()["grain"] == "M"


def test_daily_spine_includes_first_value_past_high(spark):
    v = values(spark, ["2020-01-01", "2020-01-02"])
    b = pp.plan_bounds(v, boundary=d("2020-01-04"))
    spine = [r[0] for r in pp.boundary_spine(spark, b).orderBy("Boundary").collect()]
    assert spine == [d("2020-01-01"), d("2020-01-02"), d("2020-01-03"), d("2020-01-04"), d("2020-01-05")]


def test_plan_actions_and_order(spark):
    v = values(spark, ["2020-01-01", "2020-03-01", "2020-06-01", "9999-12-31"])
    b = pp.plan_bounds(v, boundary=d("2020-04-15"), grain="M")
    plan = [(r["Boundary"], r["Action"]) for r in pp.partition_plan(spark, v, b, gap_fill=True, trim=True).orderBy("i").collect()]
    # inserts (newest first when run from the last i back) then merges
    assert plan == [
        ("2020-06-01 00:00:00.000", "Merge"),
        ("2020-02-01 00:00:00.000", "Insert"),
        ("2020-04-01 00:00:00.000", "Insert"),
        ("2020-05-01 00:00:00.000", "Insert"),
        ("9999-12-31 23:59:59.999", "Insert"),
    ]
    keep = pp.partition_plan(spark, v, b).collect()
    assert {(r["Boundary"], r["Action"]) for r in keep} == {
        ("2020-05-01 00:00:00.000", "Insert"),
        ("9999-12-31 23:59:59.999", "Insert"),
    }


def test_tiers(spark):
    parts = spark.createDataFrame(
        [("s", "t", n, "ROW") for n in range(1, 8)],
        "SchemaName string, ObjectName string, PartitionNumber int, CurrentCompression string",
    )
    assert pp.partition_tiers(parts, None) is None
    t = {r["PartitionNumber"]: r["TargetCompression"] for r in pp.partition_tiers(parts, 4).collect()}
    assert t == {2: "PAGE", 3: "PAGE"}
    t0 = {r["PartitionNumber"] for r in pp.partition_tiers(parts, 0).collect()}
    assert t0 == {2, 3, 4, 5, 6, 7}


def test_rewrite_tiers_replaces_only_listed_partitions(spark, scratch):
    import os

    path = os.path.join(scratch, "ds")
    data = spark.createDataFrame([(i, i % 3) for i in range(30)], "v int, p int")
    data.write.partitionBy("p").parquet(path)
    before = {p: os.listdir(os.path.join(path, f"p={p}")) for p in range(3)}
    rows = spark.read.parquet(path).where("p = 1").withColumn("TargetCompression", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("PAGE")).checkpoint()
    pp.rewrite_tiers(rows, path, ["p"])
    after = {p: os.listdir(os.path.join(path, f"p={p}")) for p in range(3)}
    assert after[0] == before[0] and after[2] == before[2] and after[1] != before[1]
    assert any("zstd" in f for f in after[1])
    assert spark.read.parquet(path).count() == 30


def test_existing_boundaries_of_a_partitioned_dataset(spark, scratch):
    import os

    path = os.path.join(scratch, "ds")
    spark.createDataFrame([(1, "2020-01-01"), (2, "2020-02-01"), (3, "2020-02-01")], "v int, month string") \
        .selectExpr("v", "to_date(month) AS month").write.partitionBy("month").parquet(path)
    got = sorted(r[0] for r in pp.existing_boundaries(spark.read.parquet(path), "month").collect())
    assert got == [d("2020-01-01"), d("2020-02-01")]


def test_merged_boundaries_fold_into_a_neighbour_that_stays(spark):
    v = values(spark, ["2020-01-01", "2020-02-01", "2020-03-01", "2020-04-01", "2020-05-01"])
    merged = [("2020-01-01 00:00:00.000", "Merge"), ("2020-03-01 00:00:00.000", "Merge"),
              ("2020-04-01 00:00:00.000", "Merge"), ("2020-07-01 00:00:00.000", "Insert")]
    plan = spark.createDataFrame(merged, "Boundary string, Action string")
    got = {r["Value"]: r["Neighbour"] for r in pp.merge_targets(v, plan).collect()}
    assert got == {
        d("2020-01-01"): d("2020-02-01"), d("2020-03-01"): d("2020-02-01"), d("2020-04-01"): d("2020-02-01"),
    }
    alone = pp.merge_targets(values(spark, ["2020-01-01"]), plan).collect()
    assert [tuple(r) for r in alone] == [(d("2020-01-01"), d("2020-01-01"))]


def test_merge_and_tiers_read_only_the_listed_partitions(spark, scratch):
    import os

    path = os.path.join(scratch, "ds")
    spark.createDataFrame([(i, f"2020-0{i}-01") for i in range(1, 5)], "v int, m string") \
        .selectExpr("v", "cast(m as timestamp_ntz) AS month").write.partitionBy("month").parquet(path)
    data = spark.read.schema("v int, month timestamp_ntz").parquet(path)
    targets = spark.createDataFrame([(d("2020-03-01"), d("2020-02-01"))], "month timestamp_ntz, Neighbour timestamp_ntz")
    moved = pp.merged_rows(data, targets, "month")
    assert [(r["v"], r["Neighbour"]) for r in moved.collect()] == [(3, d("2020-02-01"))]
    tiers = spark.createDataFrame([(1, d("2020-04-01"), "PAGE")], "i int, month timestamp_ntz, TargetCompression string")
    cold = pp.tier_rows(data, tiers, ["month"])
    assert [(r["v"], r["TargetCompression"]) for r in cold.collect()] == [(4, "PAGE")]
    for df in (moved, cold):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = next(x for x in plan.splitlines() if "PartitionFilters" in x)
        assert "PartitionFilters: []" not in scan

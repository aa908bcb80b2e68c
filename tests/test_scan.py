"""Split running aggregates: balanced parts and the same results as one window."""

from pyspark.sql import functions as F

from tidemark.operators.scan import PART, running, with_parts


def test_packed_hot_group_splits_evenly_and_sums_match(spark):
    # 990 values packed together and 10 far away: equal-width cuts would put
    # almost everything in one part
    vals = [(1, i) for i in range(990)] + [(1, 10**9 + i) for i in range(10)] + [(2, i) for i in range(5)]
    df = spark.createDataFrame(vals, "g int, o bigint")
    parted = with_parts(df, ["g"], F.col("o"), hot_rows=100)
    assert parted.split
    sizes = [r["count"] for r in parted.df.where("g = 1").groupBy(PART).count().collect()]
    assert len(sizes) >= 8 and max(sizes) <= 250
    got = running(parted, ["g"], ["o"], F.lit(1), "sum", "n").df
    got = running(type(parted)(got, parted.group, True), ["g"], ["o"], F.col("o"), "min", "nxt", reverse=True, inclusive=False).df
    rows = {(r["g"], r["o"]): (r["n"], r["nxt"]) for r in got.collect()}
    ordered = {g: sorted(o for gg, o in vals if gg == g) for g in (1, 2)}
    for g, os_ in ordered.items():
        for idx, o in enumerate(os_):
            nxt = os_[idx + 1] if idx + 1 < len(os_) else None
            assert rows[(g, o)] == (idx + 1, nxt)


def test_more_than_128_parts(spark):
    df = spark.range(4000).selectExpr("1 as g", "id as o")
    parted = with_parts(df, ["g"], F.col("o"), hot_rows=10)
    sizes = [r["count"] for r in parted.df.groupBy(PART).count().collect()]
    assert len(sizes) > 350 and max(sizes) <= 25


def test_nulls_in_the_group_give_the_same_rows_split_and_plain(spark):
    vals = [(1, None if i % 3 else "s", i) for i in range(60)]
    df = spark.createDataFrame(vals, "g int, s string, o bigint")
    made = []
    for hot in (5, 1000):
        parted = with_parts(df, ["g"], F.col("o"), hot_rows=hot)
        assert parted.split == (hot == 5)
        out = running(parted, ["g", "s"], ["o"], F.col("o"), "max", "p", inclusive=False).df
        made.append(sorted((r["o"], -1 if r["p"] is None else r["p"]) for r in out.collect()))
    assert made[0] == made[1]

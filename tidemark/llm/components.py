"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (a, b: long) but the roots.

    The root is the component's smallest node. Each round links every node to
    the smallest of its neighbourhood, first towards larger then towards
    smaller neighbours, and writes the links to the checkpoint folder; the
    number of rounds is logarithmic. Self-links and repeats do no harm; an
    empty table gives an empty table. Only a count and a checksum of the
    links reach the driver.
    """
    e = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct()
    e = cut(e)
    last = None
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == last or mark[0] == 0:
            return e.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
        last = mark
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(e.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = large.filter("hi <> lo").distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array("hi", "lo")).alias("hi"), F.col("m").alias("lo"))
        e = cut(small.filter("hi <> lo").distinct())

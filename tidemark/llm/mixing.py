"""Mixing sources to target weights by weighted fair queueing.

Every document of a source stands up to three times in the source's queue:
pass 0, 1, 2, each pass shuffled by ``md5(document:pass)``, where the document is its id and, if given, a
digest of its text. Its virtual finish
time is the source's cumulative words at that place divided by the source's
target. All queues are merged by finish time and cut where the running total
passes the budget, so every source has then had nearly its target.

The running sums are two-level. A queue is cut into buckets by the leading
digits of the shuffle key (uniform; about as many buckets as a bucket has rows,
so neither outgrows a task), the merged queue into ranges of finish time; bucket totals
give each bucket's start, and a window runs inside one bucket only. Only ids
and sizes are shuffled: each source's last taken key per pass comes back as
one row per source and is compared with every document in place.

Results at the edges: a null or empty text has size 0 and takes 0 words; null
sources are one source, the last in order; rows that share a doc_id
(and the digest, if one is given) are peers in the shuffle and are taken
together or not at all, so give a digest where ids may be null or repeat. An empty table gives an
empty table; a budget of 0 words takes nothing. A column of the input that is
named like a result is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, cut

PASSES = 3
BUCKET_ROWS = 4096


def size_of(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """One row per source: ``source, source_size, budget, target``.

    Targets share all words by weight, none above ``PASSES`` times the
    source's size. With sources ordered by cap / weight, the level is the
    first at which the next source is not filled up by its share.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("w", weight)
    s = s.withColumns({"cap": PASSES * F.col("source_size"), "budget": F.sum("source_size").over(Window.partitionBy())})
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.asc_nulls_last("source"))
    below = F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(fill.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("level", (F.col("budget") - below) / rest)
    s = s.withColumn("open", F.when(F.col("cap") / F.col("w") > F.col("level"), F.col("level")))
    level = F.first("open", ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.least(F.col("cap").cast("double"), F.coalesce(level * F.col("w"), F.col("cap").cast("double")))
    return s.select("source", "source_size", "budget", target.alias("target"))


def shuffle_key(doc_id: Column, turn: Column | int, digest: Column | None = None) -> Column:
    """Place of a document in one pass of its source's queue."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    if digest is not None:
        name = F.concat(name, F.lit(":"), F.coalesce(digest, F.lit("")))
    turn = F.lit(turn) if isinstance(turn, int) else turn
    return F.concat(F.md5(F.concat_ws(":", name, turn.cast("string"))), name)


def last_taken(
    sized: DataFrame, targets: DataFrame, bucket_rows: int | None = None, digest: str | None = None
) -> DataFrame:
    """``source, last``: per pass the last shuffle key that the mix takes, or null."""
    rows = sized.count()
    bucket_rows = bucket_rows or max(BUCKET_ROWS, math.isqrt(rows))
    digits = max(1, math.ceil(math.log(max(rows / bucket_rows, 1), 16)))
    t = targets.withColumnRenamed("source", "_s")
    q = sized.filter("size > 0").join(t, F.col("source").eqNullSafe(F.col("_s")))
    q = q.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1))))
    q = q.withColumn("key", shuffle_key(F.col("doc_id"), F.col("turn"), F.col(digest) if digest else None))
    q = q.select("source", "size", "target", "budget", "turn", "key")
    q = q.withColumn("bucket", F.substring("key", 1, digits))
    inside = Window.partitionBy("source", "turn", "bucket").orderBy("key")
    # one row per key: repeated documents are peers
    keyed = q.groupBy("source", "turn", "bucket", "key", "target", "budget").agg(F.sum("size").alias("size"))
    starts = q.groupBy("source", "turn", "bucket").agg(F.sum("size").alias("total"))
    before = Window.partitionBy("source").orderBy("turn", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("start", F.coalesce(F.sum("total").over(before), F.lit(0)))
    keyed = keyed.withColumn("upto", F.sum("size").over(inside))
    a, b = keyed.alias("a"), starts.alias("b")
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.turn") == F.col("b.turn")) & (
        F.col("a.bucket") == F.col("b.bucket")
    )
    finish = (F.col("b.start") + F.col("a.upto")) / F.col("a.target")
    timed = a.join(b, same).select("a.*", finish.alias("finish"))

    ranges = 16**digits
    timed = cut(timed.withColumn("span", F.least(F.floor(F.col("finish") * ranges), F.lit(2 * ranges)).cast("long")))
    spans = timed.groupBy("span").agg(F.sum("size").alias("in_span"), F.max("budget").alias("budget"))
    spans = spans.withColumn("upto", F.sum("in_span").over(Window.orderBy("span")))
    passing = spans.filter("upto > budget").orderBy("span").first()  # the range in which the budget ends
    if passing:
        full, edge = timed.filter(F.col("span") < passing["span"]), timed.filter(F.col("span") == passing["span"])
        merged = F.sum("size").over(Window.partitionBy("span").orderBy("finish"))
        before = passing["upto"] - passing["in_span"]
        edge = edge.withColumn("merged", merged + before).filter("merged <= budget").drop("merged")
    else:
        full, edge = timed, timed.limit(0)
    taken = full.unionByName(edge).groupBy("source")
    return taken.agg(
        F.array(*[F.max(F.when(F.col("turn") == i, F.col("key"))) for i in range(PASSES)]).alias("last")
    )


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), digest: str | None = None) -> DataFrame:
    """``docs`` (doc_id, source, size, ...; ``digest`` names a column that tells texts apart) with ``source_size, target, copies, taken``.

    ``copies`` is how often the mix takes the document, ``taken`` its words.
    """
    docs = docs.drop("source_size", "target", "copies", "taken")
    sized = cut(docs.select("doc_id", "source", "size", *([digest] if digest else [])))
    targets = cut(source_targets(sized, weights))
    t, m = targets.alias("t"), last_taken(sized, targets, digest=digest).alias("m")
    ends = t.join(m, F.col("t.source").eqNullSafe(F.col("m.source")), "left").select(
        F.col("t.source").alias("_s"), "source_size", "target", "last"
    )
    told = F.col(digest) if digest else None
    reached = [
        F.coalesce(shuffle_key(F.col("doc_id"), i, told) <= F.col("last")[i], F.lit(False)).cast("int")
        for i in range(PASSES)
    ]
    copies = F.when(F.col("size") > 0, sum(reached[1:], reached[0])).otherwise(0)
    out = docs.join(cut(ends), F.col("source").eqNullSafe(F.col("_s"))).withColumn("copies", copies)
    return out.withColumn("taken", F.col("copies") * F.col("size")).drop("_s", "last")

"""Conversation prefix trie, built as a distributed z-fast trie.

Rebuilding. Turns are numbered by (turn, null first, role, text hash); a
conversation that holds a large share of all turns is cut into ordered parts
for it. The first turns of a conversation are replaced by those of another, as
``rebuilt`` says.

Prefix hashes. A turn's two 64-bit hashes take its place in; the exclusive-or
of the first d of them names a prefix of d turns. They lie in blocks of
``BLOCK`` places per conversation (so no row grows with a conversation), with
running totals between blocks.

The trie. A compacted node stands for the edge of depths (lo, hi] on the path
of a conversation ``rep``; branching points and the ends of conversations are
nodes. Its handle is the prefix at the two-fattest depth of (lo, hi] - the one
with the most trailing zero bits - and the table of handles is the dictionary.

Inserting, in batches. All conversations still outside look for their exit
node at once: a fat binary search over depths asks the dictionary for the
prefix at the two-fattest depth of what is left, going below the node on a hit
and above the depth on a miss; one more look, for the child's first prefix, and
a comparison along one edge give the exit depth. All exit points split their
edges. Of the conversations that leave with the same next turn one (by hash)
enters with all its turns; the others, whose exit is deeper now, are the next
batch. With the one taken by hash the batches shrink geometrically; there are
as many as the logarithm of the largest such group, more or less.

Expanding. Subtree counts and sums are taken over pairs of a compacted node
and its compacted ancestors (no more than turns); then each edge is expanded
into the nodes of its depths.

A node under many conversations is a frequent join key: node tables are
broadcast only under the checked limit, else such joins are left to Spark's
adaptive skew join; sums over them are combined before the shuffle.

Results at the edges: null roles and texts are empty strings; a null turn
comes first, ties are ordered by role, then text hash, wholly equal rows are
turns of their own. Rows with a null conv_id are one conversation without a
number: it is not rebuilt, it comes last among members (so it is the smallest of its
own nodes alone, as null), and its decimal form is empty. An empty table gives an empty table; columns beyond the
four are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.operators.scan import running, with_parts
from tidemark.operators.sizing import bounded_broadcast
from tidemark.session import ensure_checkpoint_dir

#: Places of a conversation in one row of the prefix table, and ids in one row of an end list.
BLOCK = 64
IDS = 1024
HEADS = 9
FAMILY = 5
NOTHING = hashlib.sha256(b"").hexdigest()
HASH = ("p1", "p2")


def numbered(convs: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """``c, d, said, size``: each conversation's turns from 1, a hash of role and text, the text's bytes."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    conv, turn = F.col("conv_id").cast("long"), F.col("turn").cast("long")
    both = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = convs.select(
        conv.isNull().alias("none"), F.coalesce(conv, F.lit(0)).alias("id"), turn.alias("turn"), role.alias("role"),
        F.unhex(F.md5(both.cast("binary"))).alias("said"), F.octet_length(text).cast("long").alias("size"),
    )
    place = F.coalesce(F.col("turn"), F.lit(-(1 << 62)))
    parted = with_parts(cut(turns), ["none", "id"], place, hot_rows)
    ranked = running(parted, ["none", "id"], ["turn", "role", "said"], F.lit(1), "sum", "d").df
    return ranked.select(F.struct("none", "id").alias("c"), F.col("d").cast("long").alias("d"), "said", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (``c, n``) and their turns after rebuilding.

    Conversation c takes the first crc32(c) % 9 turns of conversation c - c % 5,
    then its own turns after as many.
    """
    block = lambda d: F.floor(d / IDS)
    own = turns.groupBy("c").agg(F.max("d").alias("n"))
    h = F.crc32(F.col("c.id").cast("string").cast("binary")) % HEADS
    own = own.select("c", "n", F.when(F.col("c.none"), F.lit(0)).otherwise(h).alias("h"))
    head = F.struct(F.lit(False).alias("none"), (F.col("c.id") - F.col("c.id") % FAMILY).alias("id"))
    heads = own.select(F.col("c").alias("g"), F.col("n").alias("g_n"))
    info = own.withColumn("g", F.when(F.col("c.none"), F.col("c")).otherwise(head)).join(heads, "g", "left")
    info = cut(info.select("c", "n", "h", "g", F.least("h", F.coalesce("g_n", F.lit(0))).alias("taken")))
    # a conversation's facts once for each range of its places, so that a long one is not one key
    facts = info.select("c", "h", "taken", F.explode(F.sequence(F.lit(0), block(F.col("n")))).alias("b"))
    kept = turns.withColumn("b", block(F.col("d"))).join(facts, ["c", "b"]).filter("d > h")
    kept = kept.select("c", (F.col("taken") + F.col("d") - F.col("h")).alias("d"), "said", "size")
    lent = turns.filter((F.col("d") < HEADS) & ~F.col("c.none")).withColumnRenamed("c", "g")
    lent = lent.join(info.filter("taken > 0 and not c.none").select("c", "g", "taken"), "g").filter("d <= taken")
    n = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return info.select("c", n.cast("long").alias("n")), kept.unionByName(lent.select("c", "d", "said", "size"))


def prefixes(convs: DataFrame, hot_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Conversations (``c, n``) as rebuilt, and their prefix table (``c, blk, ps``).

    ``ps`` has, for the places of a block in order: the prefix hash (p1, p2),
    the bytes of the last text and of all texts so far.
    """
    every, placed = rebuilt(cut(numbered(convs, hot_rows)))
    placed = placed.withColumn("blk", F.floor((F.col("d") - 1) / BLOCK)).select(
        "c", "blk", "d", "size", *[F.xxhash64(F.lit(k), "d", "said").alias(p) for k, p in enumerate(HASH)]
    )
    inside = Window.partitionBy("c", "blk").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("c").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.select("c", "blk", "d", "size", F.sum("size").over(inside).alias("sum"), *[F.bit_xor(p).over(inside).alias(p) for p in HASH])
    local = local.groupBy("c", "blk").agg(F.sort_array(F.collect_list(F.struct("d", *HASH, "size", "sum"))).alias("ps"))
    local = cut(local)
    last = F.element_at("ps", -1)
    carry = local.select(
        "c", "blk",
        F.coalesce(F.sum(last["sum"]).over(before), F.lit(0)).alias("c_sum"),
        *[F.coalesce(F.bit_xor(last[p]).over(before), F.lit(0)).alias(f"c_{p}") for p in HASH],
    )
    whole = lambda x: F.struct(
        *[x[p].bitwiseXOR(F.col(f"c_{p}")).alias(p) for p in HASH], x["size"].alias("size"), (x["sum"] + F.col("c_sum")).alias("sum")
    )
    table = local.join(carry, ["c", "blk"]).select("c", F.col("blk").cast("long").alias("blk"), F.transform("ps", whole).alias("ps"))
    return every, cut(table)


def blk_of(d: Column) -> Column:
    return F.floor((F.greatest(d, F.lit(1)) - 1) / BLOCK)


def looked_up(rows: DataFrame, table: DataFrame, c: str, d: Column, *names: str) -> DataFrame:
    """``rows`` with the prefix hash of conversation ``c`` at depth ``d`` (of depth 0: zeros) as ``names``.

    A third name takes the bytes of all texts up to there.
    """
    at = F.get("_ps", ((d - 1) % BLOCK).cast("int"))
    t = table.select(F.col("c").alias("_c"), F.col("blk").alias("_blk"), F.col("ps").alias("_ps"))
    found = rows.join(t, (F.col(c) == F.col("_c")) & (blk_of(d) == F.col("_blk")), "left")
    got = [F.when(d > 0, at[f]).otherwise(F.lit(0)).alias(n) for n, f in zip(names, (*HASH, "sum"))]
    return found.select(*rows.columns, *got)


def two_fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] with the most trailing zero bits."""
    high = F.length(F.bin(a.bitwiseXOR(b))) - 1
    # Spark has no shift by a column in its functions: clear the low bits by division
    step = F.pow(F.lit(2.0), high).cast("long")
    return F.when(a < b, b - b % step).otherwise(F.lit(0))


def written(df: DataFrame) -> DataFrame:
    """``df`` by way of a table in the shared folder.

    A checkpoint keeps what the optimizer knows of its columns; over the steps
    of a search this knowledge grows until planning takes longer than the work.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/trie-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def located(pending: DataFrame, nodes: DataFrame, n_nodes: int, table: DataFrame, steps: int) -> DataFrame:
    """Exit edge (``rep, lo, hi``) and exit depth ``e`` of each pending conversation (``c, n, a``).

    ``a``: the depth of a node known to be on its path.
    """
    handles = nodes.select(
        F.col("f").alias("k_f"), F.col("f1").alias("k1"), F.col("f2").alias("k2"),
        F.struct("rep", "lo", "hi", "f").alias("hit"),
    )
    firsts = nodes.select((F.col("lo") + 1).alias("k_f"), F.col("g1").alias("k1"), F.col("g2").alias("k2"), F.struct("rep", "lo", "hi").alias("child"))
    handles, firsts = bounded_broadcast(handles, n_nodes), bounded_broadcast(firsts, n_nodes)
    t = table.select(F.col("c").alias("_c"), F.col("blk").alias("_blk"), F.col("ps").alias("_ps"))

    def asked(s: DataFrame, answers: DataFrame) -> DataFrame:
        """The answers to the conversations' prefixes at depth ``f``; done rows (0) ask, each by a key of its own, for what is not there."""
        at = F.get("_ps", ((F.col("f") - 1) % BLOCK).cast("int"))
        own = F.when(F.col("f") > 0, at["p1"]).otherwise(F.xxhash64("c"))
        found = s.join(t, (F.col("c") == F.col("_c")) & (blk_of(F.col("f")) == F.col("_blk")), "left")
        return found.join(answers, (F.col("k_f") == F.col("f")) & (F.col("k1") == own) & (F.col("k2") == at["p2"]), "left")

    none = F.lit(None).cast("struct<rep:struct<none:boolean,id:bigint>,lo:bigint,hi:bigint,f:bigint>")
    n = F.col("n")
    s = pending.select("c", "n", "a", n.alias("b"), none.alias("node"), two_fattest(F.col("a"), n).alias("f"))
    hit = F.col("hit").isNotNull()
    a = F.when(hit, F.col("hit.hi")).otherwise(F.col("a"))
    b = F.when(hit | (F.col("f") == 0), F.col("b")).otherwise(F.col("f") - 1)
    for _ in range(steps):
        s = asked(s, handles).select("c", "n", a.alias("a"), b.alias("b"), F.when(hit, F.col("hit")).otherwise(F.col("node")).alias("node"))
        s = written(s.withColumn("f", two_fattest(F.col("a"), F.col("b"))))
    child = F.when(F.col("a") < n, F.col("a") + 1).otherwise(F.lit(0))  # the depth of the child's first prefix
    s = asked(s.withColumn("f", child), firsts)
    pick = lambda f: F.coalesce(F.col(f"child.{f}"), F.col(f"node.{f}"))
    known = F.coalesce(F.col("child.lo") + 1, F.col("node.f"), F.col("a"))
    s = s.select("c", "n", pick("rep").alias("rep"), pick("lo").alias("lo"), F.coalesce(pick("hi"), F.col("a")).alias("hi"), known.alias("known"))
    # compare along the edge, block by block
    s = s.withColumn("up", F.least("hi", "n"))
    s = s.withColumn("blk", F.explode(F.sequence(F.floor(F.col("known") / BLOCK), blk_of(F.greatest("up", F.col("known") + 1)))))
    mine = table.select("c", "blk", "ps")
    theirs = table.select(F.col("c").alias("rep"), "blk", F.col("ps").alias("rs"))
    s = s.join(mine, ["c", "blk"], "left").join(theirs, ["rep", "blk"], "left")
    base = F.col("blk") * BLOCK
    first, last = F.greatest("known", base) - base + 1, F.least(F.col("up"), base + BLOCK) - base
    equal = lambda i: (F.get("ps", i - 1)["p1"] == F.get("rs", i - 1)["p1"]) & (F.get("ps", i - 1)["p2"] == F.get("rs", i - 1)["p2"])
    shared = F.when(first <= last, F.size(F.filter(F.sequence(first, last), lambda i: equal(i.cast("int"))))).otherwise(F.lit(0))
    s = s.withColumn("shared", F.when(F.col("rep").isNull(), F.lit(0)).otherwise(shared))
    edge = ["c", "n", "rep", "lo", "hi", "known"]
    return s.groupBy(*edge).agg(F.sum("shared").alias("shared")).select("c", "n", "rep", "lo", "hi", (F.col("known") + F.col("shared")).alias("e"))


def compacted(strings: DataFrame, table: DataFrame) -> tuple[DataFrame, int]:
    """The trie's compacted nodes (``rep, lo, hi`` and the hashes of its dictionary) over distinct conversations (``c, n``)."""
    spark = strings.sparkSession
    key = "struct<none:boolean,id:bigint>"
    nodes = spark.createDataFrame([], f"rep {key}, lo long, hi long, f long, f1 long, f2 long, g1 long, g2 long")
    pending = written(strings.filter("n > 0").select("c", "n", F.lit(0).cast("long").alias("a")))
    n_nodes = 0
    while True:
        left, longest = pending.agg(F.count("*"), F.max(F.col("n") - F.col("a"))).first()
        if not left:
            return nodes, n_nodes
        if n_nodes:
            at = written(located(pending, nodes, n_nodes, table, int(longest).bit_length()))
        else:
            free = [F.lit(None).cast(t).alias(x) for x, t in (("rep", key), ("lo", "long"), ("hi", "long"))]
            at = pending.select("c", "n", *free, F.lit(0).cast("long").alias("e"))
        ends = nodes.select("rep", "lo", "hi", F.col("hi").alias("e"))
        cuts = at.filter("lo < e and e < hi").select("rep", "lo", "hi", "e").distinct()
        over = Window.partitionBy("rep", "hi").orderBy("e")
        parts = ends.unionByName(cuts).select("rep", F.coalesce(F.lag("e").over(over), "lo").alias("lo"), F.col("e").alias("hi"))
        out = looked_up(at.filter("e < n"), table, "c", F.col("e") + 1, "x1", "x2")
        out = written(out.select("c", "n", "e", "x1", "x2"))
        first = out.groupBy("x1", "x2").agg(F.min(F.struct(F.xxhash64("c.id"), "c", "n", "e")).alias("w"))
        first = written(first.select(F.col("w.c").alias("rep"), F.col("w.e").alias("lo"), F.col("w.n").alias("hi")))
        new = parts.unionByName(first).withColumn("f", two_fattest(F.col("lo"), F.col("hi")))
        new = looked_up(new, table, "rep", F.col("f"), "f1", "f2")
        nodes = written(looked_up(new, table, "rep", F.col("lo") + 1, "g1", "g2"))
        n_nodes = nodes.count()
        entered = first.select(F.col("rep").alias("c"))
        pending = written(out.join(entered, "c", "left_anti").select("c", "n", F.col("e").alias("a")))


def classes(convs: DataFrame) -> DataFrame:
    """Equal conversations (``n, e1, e2``: length and hash): members, the least, and the digest of their numbers.

    The numbers are written down in blocks of up to ``IDS`` by many tasks; the
    digest alone is taken in one ordered pass, over a block at a time.
    """
    names = ["n", "e1", "e2", "m", "least_none", "least_id", "ends"]
    text = F.when(F.col("c.none"), F.lit("")).otherwise(F.col("c.id").cast("string"))
    blocks = convs.withColumn("blk", F.floor(F.col("c.id") / IDS)).groupBy("n", "e1", "e2", F.col("c.none").alias("none"), "blk").agg(
        F.count("*").alias("k"), F.min("c").alias("c"), F.sort_array(F.collect_list(F.struct("c.id", text.alias("t")))).alias("ids")
    )
    blocks = blocks.select("n", "e1", "e2", "none", "blk", "k", "c.id", F.array_join("ids.t", ",").alias("t"))
    blocks = blocks.repartition("n", "e1", "e2").sortWithinPartitions("n", "e1", "e2", "none", "blk")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sha, row = None, None, None
        for f in frames:
            out = []
            for n, e1, e2, none, k, i, t in zip(f["n"], f["e1"], f["e2"], f["none"], f["k"], f["id"], f["t"]):
                if (n, e1, e2) != now:
                    if row:
                        out.append((*now, *row, sha.hexdigest()))
                    now, sha, row = (n, e1, e2), hashlib.sha256(t.encode()), [k, none, i]
                else:
                    sha.update(f",{t}".encode())
                    row[0] += k
            yield pd.DataFrame(out, columns=names)
        if row:
            yield pd.DataFrame([(*now, *row, sha.hexdigest())], columns=names)

    schema = "n long, e1 long, e2 long, m long, least_none boolean, least_id long, ends string"
    got = blocks.select("n", "e1", "e2", "none", "k", "id", "t").mapInPandas(run, schema)
    return got.select("n", "e1", "e2", "m", F.struct(F.col("least_none").alias("none"), F.col("least_id").alias("id")).alias("c"), "ends")


def places(rows: DataFrame, table: DataFrame, lo: Column, hi: Column, rep: str = "rep") -> DataFrame:
    """A row for each depth ``d`` in (lo, hi] of conversation ``rep``, with ``p1, p2, size, sum`` there."""
    rows = rows.withColumn("blk", F.explode(F.sequence(blk_of(lo + 1), blk_of(hi))))
    t = table.select(F.col("c").alias("_c"), F.col("blk").alias("_blk"), "ps")
    found = rows.join(t, (F.col(rep) == F.col("_c")) & (F.col("blk") == F.col("_blk")))
    found = found.select(*[c for c in rows.columns if c != "blk"], "blk", F.posexplode("ps").alias("_i", "_p"))
    found = found.withColumn("d", F.col("blk") * BLOCK + F.col("_i") + 1).filter((F.col("d") > lo) & (F.col("d") <= hi))
    return found.select(*[c for c in rows.columns if c != "blk"], "d", "_p.*")


def trie(convs: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """One row per prefix of the rebuilt conversations, as the module says."""
    every, table = prefixes(convs, hot_rows)
    every = cut(looked_up(every, table, "c", F.col("n"), "e1", "e2"))
    same = cut(classes(every))
    nodes, n_nodes = compacted(same.select("c", "n"), table)
    nodes = looked_up(nodes.select("rep", "lo", "hi"), table, "rep", F.col("hi"), "e1", "e2", "to")
    nodes = looked_up(nodes, table, "rep", F.col("lo"), "q1", "q2", "start")
    below = nodes.groupBy(F.col("lo").alias("hi"), F.col("q1").alias("e1"), F.col("q2").alias("e2")).agg(F.count("*").alias("n_children"))
    ends = same.select(F.col("n").alias("hi"), "e1", "e2", "m", "c", "ends")
    nodes = cut(nodes.join(below, ["hi", "e1", "e2"], "left").join(ends, ["hi", "e1", "e2"], "left"))
    at = ["hi", "e1", "e2"]
    # each compacted node and its compacted ancestors, itself included
    up = nodes.select("rep", "hi", "e1", "e2", "m", "c", F.col("n_children").isNull().alias("leaf"), (F.col("to") - F.col("start")).alias("bytes"))
    up = places(up, table, F.lit(0), F.col("hi"))
    v = bounded_broadcast(nodes.select(F.col("hi").alias("v_hi"), F.col("e1").alias("v1"), F.col("e2").alias("v2")), n_nodes)
    up = up.join(v, (F.col("d") == F.col("v_hi")) & (F.col("p1") == F.col("v1")) & (F.col("p2") == F.col("v2")))
    up = cut(up.select(*at, "m", "c", "leaf", "bytes", "v_hi", "v1", "v2"))
    by_v = [F.col(x).alias(y) for x, y in zip(("v_hi", "v1", "v2"), at)]
    counts = up.groupBy(*by_v).agg(
        F.sum("m").alias("n_convs"), F.min("c").alias("least"), F.sum(F.col("leaf").cast("long")).alias("n_leaves")
    )
    counts = cut(counts)
    sums = up.join(counts.select(*at, "n_convs"), at).groupBy(*by_v).agg(F.sum((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    full = cut(nodes.drop("m", "c").join(counts, at).join(sums, at))
    whole = every.agg(F.count("*").alias("n"), F.min("c").alias("c")).first()
    if not whole["n"]:
        least = None
    else:
        least = None if whole["c"]["none"] else whole["c"]["id"]
    number = lambda c: F.when(~c["none"], c["id"])
    # expand the edges
    parent = bounded_broadcast(full.select(F.col("hi").alias("lo"), F.col("e1").alias("q1"), F.col("e2").alias("q2"), F.col("least").alias("over")), n_nodes)
    top = full.filter("lo = 0").withColumn("parent", F.lit(least).cast("long"))
    deep = full.filter("lo > 0").join(parent, ["lo", "q1", "q2"]).withColumn("parent", number(F.col("over"))).drop("over")
    edges = top.unionByName(deep).select(
        "rep", "lo", "hi", "start", "parent", "n_convs", "least", "n_leaves", "saved", "n_children", "ends"
    )
    rows = places(edges, table, F.col("lo"), F.col("hi"))
    last = F.col("d") == F.col("hi")
    rows = rows.select(
        number(F.col("least")).alias("conv_id"),
        F.col("d").cast("long").alias("depth"),
        F.when(F.col("d") == F.col("lo") + 1, F.col("parent")).otherwise(number(F.col("least"))).alias("parent_conv_id"),
        F.col("n_convs").cast("long").alias("n_convs"),
        F.when(last, F.coalesce("n_children", F.lit(0))).otherwise(F.lit(1)).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("saved") - (F.col("n_convs") - 1) * (F.col("sum") - F.col("size") - F.col("start"))).alias("saved_tokens"),
        F.when(last & F.col("ends").isNotNull(), F.col("ends")).otherwise(F.lit(NOTHING)).alias("ends_sha256"),
    )
    total = full.agg(
        F.sum(F.when(F.col("lo") == 0, 1)).alias("n_children"),
        F.sum(F.when(F.col("n_children").isNull(), 1)).alias("n_leaves"),
        F.sum(F.when(F.col("lo") == 0, F.col("saved"))).alias("saved"),
    )
    turnless = same.filter("n = 0").agg(F.max("ends").alias("ends"))
    root = total.join(F.broadcast(turnless)).filter(F.lit(whole["n"] > 0)).select(
        F.lit(least).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(whole["n"]).cast("long").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).cast("long").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"),
    )
    return rows.unionByName(root)

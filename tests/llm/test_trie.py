import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm import trie
from tidemark.llm.common import table
from tidemark.llm.queries import op13_conversation_prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """The contract's rows by walking every prefix of every conversation."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        both = f"{len(role or '')}:{role or ''}{text or ''}"
        key = (turn is not None, turn or 0, role or "", hashlib.md5(both.encode()).digest())
        convs[c].append((key, (role or "", text or "")))
    own = {c: [x for _, x in sorted(t)] for c, t in convs.items()}
    built = {}
    for c, t in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 9
        base = None if c is None else c - (c % 5 if c >= 0 else -(-c % 5))
        built[c] = tuple((own.get(base, [])[:h] if c is not None else []) + t[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
            if d:
                children[t[: d - 1]].add(t[:d])
    order = lambda c: (c is None, c or 0)
    out = []

    def subtree(node):
        todo, leaves, saved = [node], 0, 0
        while todo:
            x = todo.pop()
            leaves += not children[x]
            saved += (len(members[x]) - 1) * len(x[-1][1].encode()) if x else 0
            todo.extend(children[x])
        return leaves, saved

    for x in list(members):
        least = min(members[x], key=order)
        parent = min(members[x[:-1]], key=order) if x else None
        ends = ",".join("" if c is None else str(c) for c in sorted((c for c in members[x] if len(built[c]) == len(x)), key=order))
        leaves, saved = subtree(x)
        out.append((least, len(x), parent, len(members[x]), len(children[x]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def many(seed, n, alphabet, length):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        rows += [(c, t, rng.choice("ua"), rng.choice(alphabet)) for t in range(rng.randint(1, length))]
    return rows


CASES = {
    "few texts": many(1, 60, ["x", "é", ""], 12),
    "one path, every depth an end": [(c, t, "u", f"t{t}") for c in range(0, 150, 5) for t in range(c // 5 + 1)],
    "blocks": [(c, t, "u", f"t{t}" if t < 60 + 2 * c else f"t{t} of {c}") for c in (0, 5, 10, 15, 20) for t in range(200)],
    "copies": [(5 * c, t, "u", f"t{t}") for c in range(40) for t in range(10)] + many(2, 30, ["x", "t1"], 9),
    "awkward": [
        (None, 1, "u", "a"), (None, None, "u", "b"), (-7, 0, "u", "a"), (-5, 0, "u", "b"), (-5, 1, None, None), (7, None, "u", "a"),
        (7, 0, "u", "a"), (7, 0, "u", "a"), (5, 0, "b", "x"), (5, 0, "a", "y"), (5, 3, "u", "long " * 50000), (9, 0, "u", "a"), (100, 5, "", ""),
    ],
}


def together():
    """All cases in one table, their numbers 10,000 apart."""
    shift = lambda c, k: None if c is None else c + 10_000 * k
    return [(shift(c, k), *r) for k, rows in enumerate(CASES.values()) for c, *r in rows]


def test_equals_the_plain_version_with_a_conversation_cut_into_parts(spark):
    rows = together()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("depth", F.lit("mine")).repartition(3)
    assert got(trie.trie(df, hot_rows=150)) == plain(rows)


def test_without_broadcast(spark):
    spark.conf.set("tidemark.broadcast.maxBytes", "1")
    try:
        assert got(trie.trie(spark.createDataFrame(CASES["awkward"], SCHEMA))) == plain(CASES["awkward"])
    finally:
        spark.conf.unset("tidemark.broadcast.maxBytes")


def test_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(op13_conversation_prefix_trie(spark, sf)) == plain(rows)


def test_an_empty_table(spark):
    assert trie.trie(spark.createDataFrame([], SCHEMA)).collect() == []


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(40) for b in range(a + 1, 41)] + [(0, 1 << 40), ((1 << 40) - 1, (1 << 40) + 5)]
    df = spark.createDataFrame(pairs, "a long, b long").select("a", "b", trie.two_fattest(F.col("a"), F.col("b")).alias("f"))
    for a, b, f in df.collect():
        want = f if b > 1000 else max(range(a + 1, b + 1), key=lambda x: x & -x)
        assert f == want and a < f <= b

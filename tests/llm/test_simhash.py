import re

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import queries, simhash
from tidemark.llm.components import components


def plain_fingerprint(text, k=3):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    grams = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(rows, radius=3):
    """{row index: smallest id} by comparing all fingerprints."""
    fps = np.array([f for _, f in rows], dtype=np.uint64)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius):
            root[find(int(j))] = find(i)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return [min((d for d in groups[find(i)] if d is not None), default=None) for i in range(len(rows))]


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in queries.op4_simhash(spark, sf).collect()}
    ids = sorted(texts)
    want = plain_components([(d, plain_fingerprint(texts[d])) for d in ids])
    assert got == {d: (plain_fingerprint(texts[d]), c) for d, c in zip(ids, want)}


def test_awkward_rows(spark, docs, no_docs):
    rows = docs.select("doc_id", "text").collect()
    got = sorted((str(r["doc_id"]), r["fp"] % 2**64, str(r["component_id"])) for r in simhash.near_duplicates(docs).collect())
    fps = [(r["doc_id"], plain_fingerprint(r["text"])) for r in rows]
    want = sorted((str(d), f, str(c)) for (d, f), c in zip(fps, plain_components(fps)))
    assert got == want
    assert simhash.near_duplicates(no_docs).count() == 0


def chained(n, seed, dense):
    """Fingerprints in chains of small steps, and a dense ball."""
    rng = np.random.default_rng(seed)
    out = list(rng.integers(0, 2**64, n, dtype=np.uint64))
    for _ in range(n):
        out.append(out[rng.integers(len(out))] ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, 3).astype(np.uint64)))
    ball = rng.integers(0, 2**64, dtype=np.uint64)
    for _ in range(dense):
        out.append(ball ^ np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, 4).astype(np.uint64)))
    return np.unique(np.array(out, dtype=np.uint64))


def groups(n, i, j):
    child, root = simhash.spanning(n, i, j)
    out = np.arange(n)
    out[child] = root
    return out


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 1500), st.integers(0, 3))
def test_shards_and_join_lose_nothing(seed, dense, leaf):
    p = chained(900, seed, dense)
    x, y = np.nonzero(np.bitwise_count(p[:, None] ^ p[None, :]) <= 3)
    want = groups(len(p), x, y)
    i, j = simhash.Shard(p, 3, seed).links()
    assert (groups(len(p), i, j) == want).all()
    tree = simhash.build_tree(p[:: 1 + leaf], 60 * (1 + leaf), 3)
    assert tree
    a, b = [], []
    for _, at in simhash.shards_of(p, tree, 3):
        i, j = simhash.Shard(p[at], 3).links()
        a.append(at[i])
        b.append(at[j])
    assert (groups(len(p), np.concatenate(a), np.concatenate(b)) == want).all()


def test_many_shards_in_spark(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 150)
    p = chained(900, 5, 300).view("<i8")
    df = spark.createDataFrame([(int(x),) for x in p], "fp long").repartition(4)
    got = {r["node"]: r["root"] for r in components(simhash.links(df, 3)).collect()}
    x, y = np.nonzero(np.bitwise_count(p.view("<u8")[:, None] ^ p.view("<u8")[None, :]) <= 3)
    order = np.argsort(p)
    rank = np.empty(len(p), dtype=int)
    rank[order] = np.arange(len(p))
    want = groups(len(p), rank[x], rank[y])
    s = p[order]
    assert got == {int(s[i]): int(s[w]) for i, w in enumerate(want) if i != w}


def test_components_of_a_long_chain(spark):
    e = [(i, i + 1) for i in range(300)] + [(1000, 1000), (5, 4), (900, 901)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(e, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {901: 900}

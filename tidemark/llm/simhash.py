"""SimHash near-duplicates, found with vantage-point trees.

A fingerprint has a bit set when more than half of the document's shingle
hashes have it. Equal fingerprints are one class, so copies never meet. The
classes are dealt to shards by a vantage-point tree fitted on a bounded
sample (``SAMPLE`` fingerprints): a node holds a fingerprint and a distance
``m``; a point goes inside when its distance is at most ``m + radius`` and
outside when it is more than ``m``. By the triangle inequality two points
within ``radius`` of each other meet in at least one shard, so points near a
boundary stand in both, and the join is exact whatever the sample was.
Shards grow with the square root of the number of classes, and so does their
number. Inside a shard the same bound prunes a recursive self-join, and
points within ``radius`` of one vantage point are linked through it alone. A
shard returns a spanning forest of its links, never all pairs.

Results at the edges: null, empty and blank texts have fingerprint 0 and are
linked like any other; a text with fewer words than a shingle is hashed
whole. A null doc_id never names a component; a component of null ids only
has a null id. Repeated rows share a class and each gets its row. An empty
table gives an empty table. Columns of the input named like a result are
replaced.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import by_batch, cut
from tidemark.llm.components import components

SEED = 42
SAMPLE = 65_536
SHARD_ROWS = 4096
LEAF = 768
BLOCK = 1 << 16
#: Texts of a batch that are Python objects at once.
ROWS = 1024


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The fingerprint of one UTF-8 text, unsigned."""
    words = (text or b"").lower().split()  # bytes: only A-Z change, only the six ASCII spaces part
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = list(itertools.accumulate(map(len, words)))
    stops = [e + i for i, e in enumerate(ends)]
    starts = [0, *(e + 1 for e in stops)]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    last = stops[min(shingle, len(words)) - 1 :]
    for at in range(0, n, BLOCK):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[at : min(n, at + BLOCK)], last[at : at + BLOCK])]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, text: str = "text", carried: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long), and what is ``carried`` along as a long."""
    carried = carried or {}
    names = ["doc_id", "fp", *carried]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = itertools.chain.from_iterable(b.column(1).slice(k, ROWS).to_pylist() for k in range(0, b.num_rows, ROWS))
            fps = np.array([fingerprint(t, shingle) for t in texts], dtype="<u8").view("<i8")
            yield pa.record_batch([b.column(0), pa.array(fps), *b.columns[2:]], names=names)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"), *[c.alias(k) for k, c in carried.items()]
    )
    return rows.mapInArrow(by_batch(run), ", ".join(f"{c} long" for c in names))


# -- the tree ---------------------------------------------------------------


def distances(points: np.ndarray, centre: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ centre)


def _split(points: np.ndarray, radius: int, rng: np.random.Generator) -> tuple[np.uint64, int, float]:
    """The best of a few vantage points: (centre, m, share of points in the larger side)."""
    best = None
    for i in rng.integers(0, len(points), 8):
        upto = np.cumsum(np.bincount(distances(points, points[i]), minlength=65 + radius))
        inside, outside = upto[np.minimum(np.arange(65) + radius, len(upto) - 1)], upto[-1] - upto[:65]
        larger = np.maximum(inside, outside)
        m = int(np.argmin(larger))
        cost = (larger[m] / len(points), (inside[m] + outside[m]) / len(points))
        if best is None or cost < best[0]:
            best = (cost, points[i], m)
    return best[1], best[2], best[0][0]


def build_tree(sample: np.ndarray, leaf: int, radius: int, seed: int = 0) -> list[tuple[int, int, int, int]]:
    """Nodes (centre, m, inside, outside); a child below 0 is shard ``-child - 1``."""
    rng, nodes, shards = np.random.default_rng(seed), [], itertools.count()

    def grow(points: np.ndarray, depth: int) -> int:
        if len(points) > max(leaf, 2) and depth < 40:
            centre, m, share = _split(points, radius, rng)
            if share < 0.95:
                nodes.append(None)
                me, d = len(nodes) - 1, distances(points, centre)
                inside = grow(points[d <= m + radius], depth + 1)
                nodes[me] = (int(centre), m, inside, grow(points[d > m], depth + 1))
                return me
        return -next(shards) - 1

    root = grow(np.unique(sample), 0)
    return nodes if root >= 0 else []


def shards_of(points: np.ndarray, tree: list, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, indices of its points) for every shard that gets some."""
    todo = [(0 if tree else -1, np.arange(len(points)))]
    while todo:
        node, at = todo.pop()
        if not len(at):
            continue
        if node < 0:
            yield -node - 1, at
            continue
        centre, m, inside, outside = tree[node]
        d = distances(points[at], np.uint64(centre))
        todo += [(inside, at[d <= m + radius]), (outside, at[d > m])]


# -- the join inside a shard -----------------------------------------------


def spanning(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (as stars) of the graph on ``n`` points with links i-j."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        while (new != new[new]).any():
            new = new[new]
        if (new == root).all():
            break
        root = new
    child = np.flatnonzero(root != np.arange(n))
    return child, root[child]


class Shard:
    """Exact links within ``radius`` among one shard's fingerprints."""

    def __init__(self, points: np.ndarray, radius: int, seed: int = 0):
        self.p, self.r, self.rng = points, radius, np.random.default_rng(seed)
        self.i, self.j, self.n = [], [], 0

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        if len(i):
            self.i.append(i)
            self.j.append(j)
            self.n += len(i)
            if self.n > 8 * len(self.p) + 100_000:
                self.i, self.j = ([x] for x in spanning(len(self.p), np.concatenate(self.i), np.concatenate(self.j)))
                self.n = len(self.i[0])

    def brute(self, a: np.ndarray, b: np.ndarray) -> None:
        step = max(1, (1 << 21) // max(1, len(b)))
        for k in range(0, len(a), step):
            part = a[k : k + step]
            x, y = np.nonzero(np.bitwise_count(self.p[part][:, None] ^ self.p[b][None, :]) <= self.r)
            self.add(part[x], b[y])

    def within(self, a: np.ndarray) -> None:
        todo = [a]
        while todo:
            a = todo.pop()
            if len(a) <= LEAF:
                self.brute(a, a)
                continue
            centre = a[self.rng.integers(len(a))]
            d = distances(self.p[a], self.p[centre])
            ball = d <= self.r
            if ball.sum() * 8 >= len(a):  # all of the ball is one component already
                self.add(a[ball], np.full(int(ball.sum()), centre))
                self.across(a[ball & (d > 0)], a[~ball & (d <= 2 * self.r)])
                todo.append(a[~ball])
                continue
            m = int(np.median(d))
            inside = d <= m
            if inside.all():
                m -= 1
                inside = d <= m
            if not inside.any():
                self.brute(a, a)
                continue
            self.across(a[inside & (d > m - self.r)], a[~inside & (d <= m + self.r)])
            todo += [a[inside], a[~inside]]

    def across(self, a: np.ndarray, b: np.ndarray) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if not len(a) or not len(b):
                continue
            if len(a) * len(b) <= LEAF * LEAF:
                self.brute(a, b)
                continue
            longer = a if len(a) >= len(b) else b
            centre = self.p[longer[self.rng.integers(len(longer))]]
            da, db = distances(self.p[a], centre), distances(self.p[b], centre)
            m = int(np.median(np.concatenate([da, db])))
            pairs = [
                (a[da <= m], b[db <= m]),
                (a[da > m], b[db > m]),
                (a[(da <= m) & (da > m - self.r)], b[(db > m) & (db <= m + self.r)]),
                (a[(da > m) & (da <= m + self.r)], b[(db <= m) & (db > m - self.r)]),
            ]
            work = sum(len(x) * len(y) for x, y in pairs)
            if work >= 0.95 * len(a) * len(b):
                self.brute(a, b)
            else:
                todo += pairs

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        self.within(np.arange(len(self.p)))
        if not self.i:
            return np.array([], dtype=int), np.array([], dtype=int)
        return spanning(len(self.p), np.concatenate(self.i), np.concatenate(self.j))


def links(points: DataFrame, radius: int) -> DataFrame:
    """``a, b``: links that connect all distinct ``fp`` within ``radius`` of each other."""
    n = points.count()
    spread = 1 << 20
    share = min(spread, math.ceil(spread * SAMPLE / max(n, 1)))
    sample = points.filter(F.pmod(F.xxhash64("fp"), F.lit(spread)) < share).select("fp")
    got = np.array([r[0] for r in sample.collect()], dtype="<i8").view("<u8")  # SAMPLE rows on average
    shard_rows = SHARD_ROWS * max(1.0, math.sqrt(n / 50_000))
    tree = build_tree(got, math.ceil(shard_rows * len(got) / max(n, 1)), radius)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            fps = f["fp"].to_numpy(dtype="<i8")
            for shard, at in shards_of(fps.view("<u8"), tree, radius):
                yield pd.DataFrame({"shard": np.int32(shard), "fp": fps[at]})

    def join(f: pd.DataFrame) -> pd.DataFrame:
        fps = f["fp"].to_numpy(dtype="<i8")
        i, j = Shard(fps.view("<u8"), radius).links()
        return pd.DataFrame({"a": fps[i], "b": fps[j]})

    out = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
    return points.select("fp").mapInPandas(deal, "shard int, fp long").groupBy("shard").applyInPandas(join, out)


def _classes(fps: DataFrame, radius: int, first: Column) -> DataFrame:
    """``c_fp, root, first``: each class, its component's root, and the least ``first`` of its rows."""
    classes = cut(fps.groupBy("fp").agg(F.min(first).alias("first")))
    roots = components(links(classes, radius))
    return classes.join(roots, classes["fp"] == roots["node"], "left").select(
        F.col("fp").alias("c_fp"), F.coalesce("root", "fp").alias("root"), "first"
    )


def row_key(docs: DataFrame, text: str = "text") -> dict[str, Column]:
    """What tells rows apart and orders them: the id (nulls last), a hash of the text, one of the whole row."""
    every = [F.col(f"`{c}`") for c in docs.columns]
    return {
        "no_id": F.col("doc_id").cast("long").isNull().cast("long"),
        "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).cast("long"),
        "text_hash": F.xxhash64(F.col(text)),
        "row_hash": F.xxhash64(F.lit(1), *every),
    }


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 3, text: str = "text") -> DataFrame:
    """``key``: the least ``row_key`` of each component, as a struct."""
    key = row_key(docs, text)
    fps = cut(fingerprints(docs, shingle, text, key))
    linked = _classes(fps, radius, F.struct(*key))
    return linked.groupBy("root").agg(F.min("first").alias("key")).select("key")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, text: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` of every row of ``docs``."""
    fps = cut(fingerprints(docs, shingle, text))
    linked = _classes(fps, radius, F.col("doc_id"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(least, "root").select("c_fp", "component_id")
    return fps.join(named, F.col("fp") == F.col("c_fp")).select("doc_id", "fp", "component_id")


def fp_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))

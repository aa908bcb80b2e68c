"""Embedding near-duplicates with a random-projection tree forest.

Equal vectors of a label are one class, so copies are counted, not compared.
Each tree splits by one random direction per level; a node's threshold is
where a bounded sample is sparsest around its median, and points close to it
spill into both children. A node whose points are all close together is not
split. Only points of a leaf (of one tree, label and dimension) are
compared, exactly, in double precision. A pair that shares several leaves is
counted in the one with the smallest number, which both points know, so links
are counted without ever listing pairs; a leaf returns link counts and a
spanning forest. A leaf with more than ``BLOCK`` points is compared in pairs
of blocks, each a task of its own, so nothing is capped.

Results at the edges: a vector that is null, empty, zero or holds a null or a
non-finite component, or has a null label, links with nothing and is its own
component. Vectors of different dimension do not link. Copies link with each
other. An empty table gives an empty table; columns of the input named like a
result are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut
from tidemark.llm.components import components
from tidemark.llm.simhash import spanning

TREES = 8
LEAF_ROWS = 768
BLOCK = 2048
#: The trees are fitted on about so many vectors (fewer where they are long).
SAMPLE = 16_384
SAMPLE_VALUES = 4_000_000
#: Points spill over within half the distance of a pair at the threshold; a node
#: stays whole where more than this share of its sample would.
SPILL = 0.4
MAX_DEPTH = 20


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Forest:
    """Trees over unit vectors of one dimension; leaves are numbered across trees."""

    def __init__(self, sample: np.ndarray, depth: int, width: float, trees: int = TREES, seed: int = 7):
        rng = np.random.default_rng([seed, sample.shape[1]])
        self.depth, self.trees = depth, trees
        self.directions = rng.standard_normal((sample.shape[1], trees * depth))
        self.low, self.high = (np.zeros((trees, 1 << depth)) for _ in range(2))
        p = sample @ self.directions
        for t in range(trees):
            below = {1: np.arange(len(sample))}
            for level in range(depth):
                nodes, below = below, {}
                for node, at in nodes.items():
                    x = p[at, t * depth + level]
                    cuts = self._cuts(np.sort(x), width)
                    self.low[t, node], self.high[t, node] = cuts
                    below[2 * node], below[2 * node + 1] = at[x <= cuts[1]], at[x >= cuts[0]]
                    for child in (2 * node, 2 * node + 1):  # too few to go on: measured by the parent's
                        if len(below[child]) < 32:
                            below[child] = at

    @staticmethod
    def _cuts(x: np.ndarray, width: float) -> tuple[float, float]:
        """The band around the best threshold, or (inf, inf): all go left."""
        at = np.quantile(x, np.linspace(0.3, 0.7, 21))
        inside = np.searchsorted(x, at + width, "right") - np.searchsorted(x, at - width, "left")
        k = int(np.argmin(inside))
        if inside[k] > SPILL * len(x):
            return np.inf, np.inf
        return at[k] - width, at[k] + width

    def leaves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) of every leaf a point stands in."""
        p, points, leaves = x @ self.directions, [], []
        for t in range(self.trees):
            at, node = np.arange(len(x)), np.ones(len(x), dtype=np.int64)
            for level in range(self.depth):
                v = p[at, t * self.depth + level]
                left, right = v <= self.high[t, node], v >= self.low[t, node]
                right |= ~left
                at = np.concatenate([at[left], at[right]])
                node = np.concatenate([2 * node[left], 2 * node[right] + 1])
            points.append(at)
            leaves.append(node - (1 << self.depth) + (t << self.depth))
        return np.concatenate(points), np.concatenate(leaves)


def forests(classes: DataFrame, threshold: float) -> dict[int, Forest]:
    """A forest for each dimension, fitted on a bounded sample."""
    sizes = classes.groupBy("dim", "label").agg(F.count("*").alias("n"))
    found = {}
    for dim, most, total in sizes.groupBy("dim").agg(F.max("n"), F.sum("n")).collect():
        # a level leaves a little more than half of the rows on a side
        depth = min(MAX_DEPTH, math.ceil(1.3 * math.log2(most / LEAF_ROWS))) if most > LEAF_ROWS else 0
        want = max(64, min(SAMPLE, SAMPLE_VALUES // dim))
        share = min(1 << 20, math.ceil((1 << 20) * want / total))
        mine = classes.filter((F.col("dim") == dim) & (F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share))
        got = np.array([r[0] for r in mine.select("v").collect()], dtype=np.float64).reshape(-1, dim)
        found[dim] = Forest(unit(got), depth, math.sqrt(2 - 2 * threshold) / 2)
    return found


def _close(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    norms = np.linalg.norm(x, axis=1)[:, None] * np.linalg.norm(y, axis=1)[None, :]
    return np.nonzero((x @ y.T) / norms >= threshold)


def _counted_here(codes: np.ndarray, i: np.ndarray, j: np.ndarray, leaf: int) -> np.ndarray:
    """Whether no leaf before this one holds both points."""
    out = np.empty(len(i), dtype=bool)
    step = max(1, (1 << 23) // codes.shape[1] ** 2)
    for k in range(0, len(i), step):
        a, b = codes[i[k : k + step]][:, :, None], codes[j[k : k + step]][:, None, :]
        out[k : k + step] = ~((a == b) & (a >= 0) & (a < leaf)).any(axis=(1, 2))
    return out


def compare(f: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Links inside one leaf, or between two blocks of it: ``id, n, root``."""
    x = np.stack([np.frombuffer(v, "<f8") for v in f["v"]])
    ids, mult = f["id"].to_numpy(np.int64), f["copies"].to_numpy(np.int64)
    codes = np.full((len(f), max(map(len, f["codes"]))), -1, dtype=np.int64)
    for k, c in enumerate(f["codes"]):
        codes[k, : len(c)] = c
    one = f["block"].to_numpy() == f["i"].iloc[0]
    a = np.flatnonzero(one)
    b = np.flatnonzero(~one) if f["i"].iloc[0] != f["j"].iloc[0] else a
    if not len(b):
        return pd.DataFrame({"id": [], "n": [], "root": []}, dtype="int64")
    i, j = _close(x[a], x[b], threshold)
    i, j = a[i], b[j]
    if b is a:
        i, j = i[i < j], j[i < j]
    child, root = spanning(len(f), i, j)
    mine = _counted_here(codes, i, j, int(f["leaf"].iloc[0]))
    n = np.bincount(i[mine], mult[j[mine]], len(f)) + np.bincount(j[mine], mult[i[mine]], len(f))
    to = ids.copy()
    to[child] = ids[root]
    some = (n > 0) | (to != ids)
    return pd.DataFrame({"id": ids[some], "n": n[some].astype("int64"), "root": to[some]})


def near_duplicates(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (vec_id, embedding, label)."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.col("label").isNotNull() & v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)
    key = F.when(F.coalesce(usable, F.lit(False)), v)
    rows = vectors.select("vec_id", "label", key.alias("v"))
    grouped = rows.filter("v is not null").groupBy("label", "v")
    classes = grouped.agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    classes = cut(classes.withColumns({"dim": F.size("v"), "id": F.monotonically_increasing_id()}))
    trees = forests(classes, threshold)

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for dim, part in f.groupby("dim"):
                x = np.stack(part["v"].to_numpy()).astype("<f8")
                at, leaf = trees[dim].leaves(unit(x))
                order = np.lexsort((leaf, at))
                at, leaf = at[order], leaf[order]
                codes = np.split(leaf, np.flatnonzero(np.diff(at)) + 1)
                blobs = [r.tobytes() for r in x]
                out = part[["id", "label", "dim", "copies"]].iloc[at].reset_index(drop=True)
                yield out.assign(leaf=leaf, codes=[codes[k] for k in at], v=[blobs[k] for k in at])

    dealt = cut(
        classes.select("id", "label", "dim", "copies", "v").mapInPandas(
            deal, "id long, label long, dim int, copies long, leaf long, codes array<long>, v binary"
        )
    )
    place = ["dim", "label", "leaf"]
    large = dealt.groupBy(*place).agg(F.count("*").alias("rows")).filter(F.col("rows") > BLOCK)
    large = large.withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int")).drop("rows")
    parted = dealt.join(large, place, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    parted = parted.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    parted = parted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    parted = parted.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    found = cut(
        parted.groupBy(*place, "i", "j").applyInPandas(lambda f: compare(f, threshold), "id long, n long, root long")
    )
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    c = classes.join(counts, "id", "left").join(roots, F.col("id") == F.col("node"), "left")
    c = c.select("label", "v", "first_id", F.coalesce("root", "id").alias("root"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    least = c.groupBy("root").agg(F.min("first_id").alias("component"))
    c = c.join(least, "root").select(F.col("label").alias("c_label"), F.col("v").alias("c_v"), "n_links", "component")
    out = rows.join(c, (F.col("label") == F.col("c_label")) & (F.col("v") == F.col("c_v")), "left")
    component = F.when(F.col("c_v").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )

"""Quality scores learnt from preferences between documents (Bradley-Terry).

Features. Each text is measured whole: shares of character classes, word and
line statistics, repeats. Nothing but the text enters.

Training. Spark measures every text once, and every labelled row outside the
held-out part teaches. A pair is a document with label 1 that is preferred to
one with label 0; every row is in ``ROUNDS`` pairs or more. The chance that the
first is preferred is the logistic function of the difference of their scores,
so the weights are a logistic regression on feature differences without an
intercept. Rows are dealt into buckets of about ``BUCKET`` rows by hash and
paired inside them; of a class so rare that a bucket might have none, each row
is dealt to several buckets. A Newton step is one Spark job: each bucket gives
its sums over pairs, the driver adds them in bucket order and solves for the
few dozen weights.

Threshold. The training rows' scores are cut at their quantile that equals the
share of label 0, found exactly by counting scores in ever narrower bins;
scores are shifted so that the cut is where the logistic score is ``cut`` (0.3
unless given).

Results at the edges: a null text counts as empty and is scored as any text.
Repeated rows and rows with a null id are scored each; a null id counts as the
empty text in the split. A label that is null or not 0 or 1, or whose document
is not there, teaches nothing; a document labelled twice is two rows. With labels of one
kind alone, or none, every score is (n1 + 1) / (n + 2). An empty table gives an
empty table; other columns, also those named like a result, are not read.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

#: Labelled rows that are paired in one task, about.
BUCKET = 16_384
#: Rows of the rarer class in each bucket, at least about (all, if there are fewer).
PARTNERS = 128
#: Bins of a count of scores, and different scores that the driver may hold.
BINS = 1024
#: Pairs of each row of the larger class.
ROUNDS = 4
PENALTY = 1e-3
STEPS = 30
#: Standardised features are cut off here, so that no single one decides far outside the sample.
FAR = 6.0
SYMBOLS = b"#*$%&|<>@~^_+=\\/{}[]"
STOPS = b".,;:!?"
_KINDS = np.zeros(256, dtype=np.int64)
for _i, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\x0b\f\r", b"\n", STOPS, SYMBOLS), 1):
    _KINDS[list(_set)] = _i
_KINDS[128:] = 8
KINDS = 9
FEATURES = KINDS + 13


def features(text: bytes | None) -> list[float]:
    """The measures of one text."""
    text = text or b""
    size = len(text)
    if not size:
        return [0.0] * FEATURES
    hist = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    kinds = np.bincount(_KINDS, weights=hist, minlength=KINDS) / size
    w = text.split()
    n = max(1, len(w))
    counts = Counter(w)
    lines = [x for x in text.split(b"\n") if x.strip()]
    n_lines = max(1, len(lines))
    again = sum(map(bytes.__eq__, w, w[1:]))
    fives = max(0, len(w) - 4)
    odd = len(w) and sum(1 for x in w if not x[-1:].isalnum() and x[-1] < 128 and x[-1:] not in b".,;:!?\"')")
    return [
        *kinds.tolist(),
        math.log1p(len(w)),
        (n - max(1, len(counts))) / n,
        math.log(max(1, len(counts))) / math.log(n + 1),
        (max(counts.values(), default=1) - 1) / n,
        again / n,
        1 - len(set(zip(w, w[1:], w[2:], w[3:], w[4:]))) / fives if fives else 0.0,
        size / n,
        sum(map(bytes.isupper, w)) / n,
        odd / n,
        text.count(b"!!") / n,
        1 - len(set(lines)) / n_lines,
        math.log1p(len(w) / n_lines),
        sum(1 for x in lines if x.rstrip()[-1:] in b".!?") / n_lines,
    ]


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


@dataclass
class Ranking:
    """Standardised linear score, shifted so that the threshold is at 0."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    shift: float
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -FAR, FAR) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        s = self.raw(x) - self.shift + math.log(self.cut / (1 - self.cut))
        return 1 / (1 + np.exp(-np.clip(s, -500, 500)))


def pairs(n1: int, n0: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Places of the preferred and of the other row of each pair."""
    most, least = max(n1, n0), min(n1, n0)
    i = np.tile(np.arange(most), rounds)
    # each round turns the smaller class by another step, so partners differ
    j = (i + np.repeat(np.arange(rounds) * max(1, least // rounds), most)) % least
    return (i, j) if n1 >= n0 else (j, i)


Bucket = tuple[np.ndarray, np.ndarray, np.ndarray]
#: Applies a function to every bucket (rows, labels, whether dealt here first); results in bucket order.
Each = Callable[[Callable[[Bucket], list[np.ndarray]]], list[list[np.ndarray]]]


def _added(each: Each, part: Callable[[Bucket], list[np.ndarray]]) -> list[np.ndarray]:
    """The sums over all buckets of what ``part`` gives for each."""
    return [sum(found[1:], start=found[0]) for found in zip(*each(part))]


def order_statistics(each: Each, raw: Callable[[np.ndarray], np.ndarray], ranks: tuple[int, int]) -> list[float]:
    """The scores at two neighbouring ranks (from 0) among the rows of all buckets."""

    def ends(b: Bucket) -> list[np.ndarray]:
        s = raw(b[0])[b[2]]
        return [np.array([s.min(), -s.max()] if len(s) else [np.inf, np.inf])]

    low, high = np.min([found[0] for found in each(ends)], axis=0) * [1, -1]
    while True:
        edges = np.linspace(low, high, BINS + 1)

        def counted(b: Bucket) -> list[np.ndarray]:
            s = np.sort(raw(b[0])[b[2]])
            inside = s[(s >= low) & (s <= high)]
            bins = np.searchsorted(inside, edges[1:-1], side="right")
            values, times = np.unique(inside, return_counts=True)
            few = len(values) <= BINS
            head = np.array([np.searchsorted(s, low), few], dtype=np.float64)
            return [head, np.diff(bins, prepend=0, append=len(inside)), values if few else values[:0], times if few else times[:0]]

        found = each(counted)
        below = int(sum(x[0][0] for x in found))
        if all(x[0][1] for x in found) and sum(len(x[2]) for x in found) <= max(BINS, 2 * len(found)) or not low < high:
            values, times = np.concatenate([x[2] for x in found]), np.concatenate([x[3] for x in found])
            order = np.argsort(values, kind="stable")
            upto = below + np.cumsum(times[order])
            return [float(values[order][np.searchsorted(upto, r, side="right")]) for r in ranks]
        upto = below + np.cumsum(sum(x[1] for x in found))
        first, last = (int(np.searchsorted(upto, r, side="right")) for r in ranks)
        low, high = edges[first], edges[last + 1]


def fit_buckets(each: Each, cut: float) -> Ranking:
    """The Bradley-Terry weights of the rows of all buckets, and the threshold."""
    n, n1, total = 0, 0, np.zeros(FEATURES)
    for own, ones, added in each(lambda b: [np.array(b[2].sum()), np.array(b[1][b[2]].sum()), b[0][b[2]].sum(axis=0)]):
        n, n1, total = n + int(own), n1 + int(ones), total + added
    flat = Ranking(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, (n1 + 1) / (n + 2))
    if not 0 < n1 < n:
        return flat
    mean = total / n
    scale = np.sqrt(_added(each, lambda b: [((b[0][b[2]] - mean) ** 2).sum(axis=0)])[0] / n)
    r = Ranking(mean, np.where(scale > 1e-9, scale, 1.0), flat.weights, 0.0, cut)
    w = r.weights

    def sums(b: Bucket) -> list[np.ndarray]:
        z = np.clip((b[0] - r.mean) / r.scale, -FAR, FAR)
        ones = int(b[1].sum())
        if not 0 < ones < len(z):
            return [np.zeros(FEATURES), np.zeros((FEATURES, FEATURES)), np.array(0)]
        up, down = pairs(ones, len(z) - ones)
        d = z[b[1] == 1][up] - z[b[1] == 0][down]
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # chance of the other order
        return [d.T @ p, (d * (p * (1 - p))[:, None]).T @ d, np.array(len(d))]

    for _ in range(STEPS):
        slope, bend, n_pairs = _added(each, sums)
        step = np.linalg.solve(bend / n_pairs + PENALTY * np.eye(FEATURES), slope / n_pairs - PENALTY * w)
        w = w + step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    r.weights = w
    r.shift = sum(order_statistics(each, r.raw, (n - n1 - 1, n - n1))) / 2
    return r


def fit(x: np.ndarray, label: np.ndarray, cut: float) -> Ranking:
    """``fit_buckets`` of rows at hand, as one bucket."""
    return fit_buckets(lambda part: [part((x, label, np.ones(len(label), dtype=bool)))], cut)


def measured(rows: DataFrame, *kept: str) -> DataFrame:
    """``rows`` (``t``: texts as binary) as columns ``kept`` and ``x``, the features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [features(t) for t in b.column(0).to_pylist()]
            yield pa.record_batch([*b.columns[1:], pa.array(x, pa.list_(pa.float64()))], names=[*kept, "x"])

    chosen = rows.select("t", *kept)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in chosen.schema.fields[1:])
    return chosen.mapInArrow(run, f"{fields}, x array<double>")


def dealt(rows: DataFrame, n1: int, n0: int, bucket: int = BUCKET) -> DataFrame:
    """``rows`` (doc_id, q, x) in buckets: one row ``bucket, x, q, own`` each, as bytes, in the order of id, label and features."""
    n = max(1, math.ceil((n1 + n0) / bucket))
    copies = [min(n, max(1, math.ceil(PARTNERS * n / max(1, k)))) for k in (n0, n1)]
    at = F.pmod(F.xxhash64("doc_id", "q", "x"), F.lit(n))
    spread = F.when(F.col("q") == 1, F.lit(copies[1])).otherwise(F.lit(copies[0]))
    several = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), spread - 1)))
    # a row's copies lie evenly over the buckets
    several = several.withColumn("bucket", (at + F.floor(F.col("copy") * n / spread)) % n)

    def packed(b: pa.Table) -> pa.Table:
        found = sorted(zip(b["doc_id"].to_pylist(), b["q"].to_pylist(), b["x"].to_pylist(), b["copy"].to_pylist()))
        x = np.array([r[2] for r in found], dtype="<f8")
        q, own = np.array([r[1] for r in found], dtype="<i8"), np.array([r[3] == 0 for r in found])
        blobs = [pa.array([a.tobytes()], pa.binary()) for a in (x, q, own)]
        return pa.table([pa.array([b["bucket"][0].as_py()], pa.int64()), *blobs], names=["bucket", "x", "q", "own"])

    return several.groupBy("bucket").applyInArrow(packed, "bucket long, x binary, q binary, own binary")


def over(buckets: DataFrame) -> Each:
    """A job over ``dealt`` rows; what it gives for a bucket is a few kilobytes."""

    def each(part: Callable[[Bucket], list[np.ndarray]]) -> list[list[np.ndarray]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for k in range(b.num_rows):
                    at, x, q, own = (c[k].as_py() for c in b.columns)
                    row = np.frombuffer(x, "<f8").reshape(-1, FEATURES), np.frombuffer(q, "<i8"), np.frombuffer(own, "?")
                    got = pa.array([pickle.dumps(part(row))], pa.binary())
                    yield pa.record_batch([pa.array([at], pa.int64()), got], names=["bucket", "got"])

        found = buckets.select("bucket", "x", "q", "own").mapInArrow(run, "bucket long, got binary").collect()
        return [pickle.loads(r["got"]) for r in sorted(found, key=lambda r: r["bucket"])]

    return each


def learn(rows: DataFrame, labels: DataFrame, cut: float, bucket: int = BUCKET) -> Ranking:
    """The ranking of all labelled training ``rows`` (doc_id, x)."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q"))
    marks = marks.filter(F.col("doc_id").isNotNull() & F.col("q").isin(0, 1) & ~held_out(F.col("doc_id")))
    found = common.cut(rows.join(marks, "doc_id").select("doc_id", "q", "x"))
    n = {r["q"]: r["count"] for r in found.groupBy("q").count().collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return fit(np.zeros((n1 + n0, FEATURES)), np.full(n1 + n0, int(n1 > 0)), cut)
    return fit_buckets(over(common.cut(dealt(found, n1, n0, bucket))), cut)


def score(docs: DataFrame, labels: DataFrame, text: str = "text", cut: float = 0.3, bucket: int = BUCKET) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("t"))
    rows = common.cut(measured(rows, "doc_id"))
    ranking = learn(rows, labels, cut, bucket)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, FEATURES)
            s = ranking.score(x)
            out = [b.column(0), pa.array(s, pa.float64()), pa.array((s >= cut).astype(np.int32))]
            yield pa.record_batch(out, names=["doc_id", "score", "predicted"])

    scored = rows.select("doc_id", "x").mapInArrow(run, "doc_id long, score double, predicted int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import lm, queries

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    """Counts and base scores, word by word."""
    split = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)), ""]
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
    c = Counter(w for d, t in rows if not out(d) for w in split(t))
    n, v = sum(c.values()), len(c)
    made = []
    for d, t in rows:
        w = split(t)
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        made.append((d, out(d), len(w), sum(c[x] > 0 for x in w), n, base))
    return sorted(made, key=lambda r: (str(r[0]), r[5]))


def check(got, rows):
    got = sorted(got, key=lambda r: (str(r["doc_id"]), r["base_score"]))
    for r, w in zip(got, plain(rows), strict=True):
        assert tuple(r)[:5] == w[:5]
        assert r["base_score"] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
    return got


@pytest.mark.parametrize("sent", [65_536, 1500])
def test_base_scores_and_a_better_model(spark, monkeypatch, sent):
    monkeypatch.setattr(lm, "SENT", sent)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = check(queries.op7_lm_scoring(spark, SF).collect(), docs)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out) * 0.97
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_awkward_rows(docs, no_docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    check(lm.score(docs).collect(), rows)
    assert lm.score(no_docs).count() == 0


@pytest.fixture(scope="module")
def small(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("text").alias("t"))
    counts = lm.word_counts(rows)
    return lm.vocabulary(counts.cache())


def test_probabilities_add_up(small):
    """Over model words and shapes, after any history."""
    net = lm.Network(small, lm.start_parameters(small))
    n = small.n_model + lm.SHAPES
    state = np.repeat(np.random.default_rng(0).standard_normal((1, lm.HIDDEN)).astype(np.float32), n, axis=0)
    logp, _ = net.output(state, np.arange(n))
    assert np.exp(logp.astype(np.float64)).sum() == pytest.approx(1, abs=1e-4)
    # within a shape: all its words, and one unseen
    for s in range(lm.SHAPES):
        total = small.shape_n[s] + 0.5 * small.shape_v[s] + 0.5
        assert total == pytest.approx(10 ** small.shape_log()[s])


def test_gradients(small):
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in lm.start_parameters(small).items()}
    x = rng.integers(0, small.inputs, (5, 3))
    y = rng.integers(0, small.n_model + lm.SHAPES, (5, 3))
    x[2, 1] = small.inputs - 1

    def loss(p):
        net = lm.Network(small, p)
        states, tape = net.forward(x, np.zeros((3, lm.HIDDEN)))
        grad = {}
        logp, back = net.output(states.reshape(-1, lm.HIDDEN).astype(np.float64), y.ravel(), grad)
        net.backward(x, tape, back.reshape(5, 3, -1), grad)
        return -logp.sum(), grad

    _, grad = loss(p)
    rows, g = grad["E"]
    dense = np.zeros(p["E"].shape)
    dense[rows] = g
    grad["E"] = dense
    for k in p:
        for at in rng.choice(np.flatnonzero(np.abs(grad[k].ravel()) > 1e-2), 6):
            h, q = 1e-3, {n: v.copy() for n, v in p.items()}
            q[k].ravel()[at] += h
            up = loss(q)[0]
            q[k].ravel()[at] -= 2 * h
            assert (up - loss(q)[0]) / (2 * h) == pytest.approx(grad[k].ravel()[at], rel=0.03, abs=2e-3)


def test_state_runs_through_whole_documents(small):
    """Laid side by side or one alone, a document's score is the same; training lowers the loss."""
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, small.n_model, n) for n in (1, 2, 500, 33, 64, 7, 1200, 1, 32)]
    net = lm.Network(small, lm.start_parameters(small))
    x, y, where = lm.lanes(docs, net.start, 3)
    together = net.score(x, y)
    for d, (lane, at) in zip(docs, where):
        assert (y[at : at + len(d), lane] == d).all() and x[at, lane] == net.start
        a, b, _ = lm.lanes([d], net.start)
        assert together[at : at + len(d), lane].sum() == pytest.approx(net.score(a, b).sum(), rel=1e-4)
    pattern = [np.tile([3, 9, 4], 200) for _ in range(30)]
    x, y, _ = lm.lanes(pattern, net.start)
    before = net.score(x, y).sum()
    net.train(x, y)
    assert net.score(x, y).sum() > before * 0.7


def test_training_carries_the_state_through_a_long_document(spark, small, monkeypatch):
    """One start per document, and the model as large as it was."""
    assert (lm.MODEL_WORDS, lm.CLASSES, lm.HIDDEN) == (1024, 24, 24)
    texts = ["the of " * 2500, "a b c"]
    rows = spark.createDataFrame([(i, t, False, i) for i, t in enumerate(texts)], "doc_id long, t string, held boolean, h long")
    coded = lm.encoded(rows.coalesce(1), small)
    p = lm.start_parameters(small)
    net = lm.Network(small, p)
    ids = [np.frombuffer(bytes(r["ids"]), "<u2") for r in coded.orderBy("h").collect()]
    assert [len(i) for i in ids] == [5001, 4] and all(i[-1] == 0 for i in ids)
    x, y, _ = lm.lanes(ids, net.start)
    assert ((x == net.start) & (y >= 0)).sum() == len(texts)
    net.train(x, y)
    got = lm.trained(coded, 5005, small, p)
    for k in p:
        assert got[k] == pytest.approx(net.p[k], rel=1e-5, abs=1e-6)


def test_words_and_shapes_are_those_of_a_plain_reader():
    texts = ["", None, " A\tb\x0b\x0cC\r\n ", "\x1c \u00a0x\u2003 \u00c4B", "x" * 9, "\n", "I1 a, \u00fc% 7"]
    words, n = lm.split_words(pa.array(texts))
    want = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) for t in texts]
    assert words.to_pylist() == [w for x in want for w in x] and n.tolist() == [len(x) for x in want]
    binary = words.cast(pa.binary())
    assert lm.shapes_of(binary).tolist() == [lm.shape(w) for w in binary.to_pylist()]
    assert lm.shapes_of(binary.slice(3)).tolist() == [lm.shape(w) for w in binary.to_pylist()[3:]]
    assert all(lm.shapes_of(pa.array([bytes([b])]))[0] == lm.shape(bytes([b])) for b in range(1, 256))


def test_scores_do_not_depend_on_partitions_or_slices(spark, monkeypatch):
    """Several trainers; rows dealt into 2 or 8 tasks, in another order, and split in small slices."""
    monkeypatch.setattr(lm, "TRAINER_TOKENS", 20_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert lm.trainers(100_000) == 3
    two = {r["doc_id"]: r for r in lm.score(docs.repartition(2)).collect()}
    monkeypatch.setattr(lm, "SLICE", 5000)
    monkeypatch.setattr(lm, "CHUNK", 2_000_000)
    for r in lm.score(docs.repartition(8, "text")).collect():
        w = two[r["doc_id"]]
        assert tuple(r)[:5] == tuple(w)[:5]
        assert r["base_score"] == pytest.approx(w["base_score"], rel=1e-9)
        assert r["score"] == pytest.approx(w["score"], rel=1e-5)


def test_padding_is_bounded(small):
    docs = [np.zeros(20_000, dtype=int), *[np.zeros(2, dtype=int)] * 500]
    x, y, where = lm.lanes(docs, small.inputs - 1)
    assert x.size <= 5 * sum(map(len, docs)) and (y >= 0).sum() == sum(map(len, docs))


def test_a_lone_long_document_is_scored_in_large_windows(small, monkeypatch):
    """The output layer's fixed costs are paid per ``WINDOW * LANES`` ids, not per ``WINDOW`` steps; the scores stay."""
    net = lm.Network(small, lm.start_parameters(small))
    doc = np.random.default_rng(4).integers(0, small.n_model + lm.SHAPES, 10_000)
    x, y, _ = lm.lanes([doc], net.start)
    want, h = [], np.zeros((1, lm.HIDDEN), dtype=np.float32)
    for t in range(0, len(x), lm.WINDOW):
        states, _ = net.forward(x[t : t + lm.WINDOW], h)
        h = states[-1]
        want.append(net.output(states[:, 0], y[t : t + lm.WINDOW, 0])[0])
    calls, output = [], net.output
    monkeypatch.setattr(net, "output", lambda s, *a: calls.append(len(s)) or output(s, *a))
    assert net.score(x, y)[:, 0] == pytest.approx(np.concatenate(want), rel=1e-4, abs=1e-5)
    assert calls == [lm.WINDOW * lm.LANES, 10_000 - lm.WINDOW * lm.LANES]


def test_softmax_and_sums_by_id_against_plain_numpy():
    rng = np.random.default_rng(5)
    for scale in (1, 200):  # within and beyond the range of exp
        rows = [(scale * rng.standard_normal(w)).astype(np.float32) for w in (3, 1, 7, 7, 2)]
        own, width = np.array([2, 0, 5, 0, 1]), np.array([len(r) for r in rows])
        want = [r.astype(float)[o] - np.logaddexp.reduce(r.astype(float)) for r, o in zip(rows, own)]
        slopes = [np.exp(r.astype(float) - np.logaddexp.reduce(r.astype(float))) - np.eye(len(r))[o] for r, o in zip(rows, own)]
        e = np.concatenate(rows)
        assert lm.softmax(e, width, np.cumsum(width) - width + own, True) == pytest.approx(want, rel=1e-4, abs=1e-4)
        assert e == pytest.approx(np.concatenate(slopes), abs=1e-4)
        e = np.concatenate(rows[2:4])
        assert lm.softmax(e, 7, np.array([5, 7]), True) == pytest.approx(want[2:4], rel=1e-4, abs=1e-4)
        assert e == pytest.approx(np.concatenate(slopes[2:4]), abs=1e-4)
    for ids in ([7], [3] * 40, [*range(50), *[5] * 20, *[8] * 3, 9], [1] * lm.OFTEN + [2] * (lm.OFTEN - 1)):
        ids = rng.permutation(np.array(ids, dtype=np.uint16))
        rows = rng.standard_normal((len(ids), 6))
        at, sums = lm.sums_by_id(ids, rows)
        assert sorted(at) == sorted(set(ids.tolist()))
        for i, s in zip(at, sums):
            assert s == pytest.approx(rows[ids == i].sum(axis=0))

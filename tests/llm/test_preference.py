import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import preference
from tidemark.llm.common import table
from tidemark.llm.queries import op11_quality_classifier


def _out(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_held_out_documents_are_told_apart(spark):
    sf = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in op11_quality_classifier(spark, sf).collect()}
    assert len(got) == table(spark, sf, "documents").select("doc_id").distinct().count()
    hits = {0: [], 1: []}
    for r in table(spark, sf, "labels").collect():
        g = got[r["doc_id"]]
        assert g["held_out"] == _out(r["doc_id"])
        assert 0 <= g["score"] <= 1 and g["predicted"] == (g["score"] >= 0.3)
        if g["held_out"]:
            hits[r["quality"]].append(g["predicted"] == r["quality"])
    assert np.mean(hits[0]) >= 0.8 and np.mean(hits[1]) >= 0.98


def test_fit_orders_pairs_and_cuts_at_the_quantile():
    rng = np.random.default_rng(1)
    label = (rng.random(600) < 0.75).astype(np.int64)
    x = rng.standard_normal((600, preference.FEATURES))
    x[:, 3] += 3.0 * label
    r = preference.fit(x, label, 0.3)
    raw = r.raw(x)
    assert np.argmax(np.abs(r.weights)) == 3
    assert (raw < r.shift).sum() == (label == 0).sum()
    assert np.array_equal(r.score(x) >= 0.3, raw >= r.shift)
    # the plain gradient of the pair loss vanishes at the weights
    z = np.clip((x - r.mean) / r.scale, -preference.FAR, preference.FAR)
    slope = np.zeros(preference.FEATURES)
    up, down = preference.pairs(int(label.sum()), int((1 - label).sum()))
    for a, b in zip(z[label == 1][up], z[label == 0][down]):
        slope += (a - b) / (1 + np.exp((a - b) @ r.weights))
    assert np.abs(slope / len(up) - preference.PENALTY * r.weights).max() < 1e-6


@pytest.mark.parametrize("n1, n0", [(1, 1), (5, 2), (2, 5), (1, 9)])
def test_every_row_is_in_a_pair(n1, n0):
    up, down = preference.pairs(n1, n0)
    assert set(up) == set(range(n1)) and set(down) == set(range(n0))


def test_only_the_text_counts_and_training_rows_alone_teach(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    labels = table(spark, "/root/testdata/sf0.001", "labels")
    plain = sorted(map(tuple, preference.score(docs, labels).collect()))
    other = docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")).withColumn("score", F.lit(3)).repartition(5)
    turned = labels.withColumn("quality", F.when(preference.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(map(tuple, preference.score(other, turned).collect())) == plain


def test_awkward_rows_are_scored(spark, docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (3, None), (6, 0), (10, 0), (12, 0), (12, 7), (99, 1), (None, 1)], "doc_id long, quality int"
    )
    got = preference.score(docs, labels).collect()
    assert len(got) == docs.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r["doc_id"], set()).add(r["score"])
    assert all(len(s) == 1 for s in by_id.values())
    assert by_id[3] == by_id[4]
    assert preference.score(no_docs, labels).collect() == []


def test_labels_of_one_kind_or_none(spark, docs):
    teach = [i for i in (1, 2, 6, 9, 10) if not _out(i)]
    one = spark.createDataFrame([(i, 1) for i in teach], "doc_id long, quality int")
    n = sum(1 if i != 2 else 2 for i in teach)
    for r in preference.score(docs, one).collect():
        assert r["score"] == pytest.approx((n + 1) / (n + 2))
    for r in preference.score(docs, one.limit(0)).collect():
        assert r["score"] == pytest.approx(0.5)


def _stored(spark, rows):
    data = [(int(i), int(q), [float(v) for v in x]) for i, (q, x) in enumerate(rows)]
    return spark.createDataFrame(data, "doc_id long, q int, x array<double>")


@pytest.mark.parametrize("zeros", [3, 150])
def test_every_labelled_row_teaches_whatever_the_bucket(spark, zeros):
    """Moments and threshold are those of all rows, and a rare class is in every bucket."""
    rng = np.random.default_rng(2)
    label = np.array([0] * zeros + [1] * (600 - zeros))
    x = np.round(rng.standard_normal((600, preference.FEATURES)), 1)
    x[:, 3] += 2.0 * label
    rows = preference.dealt(_stored(spark, zip(label, x)), 600 - zeros, zeros, bucket=100).checkpoint()
    each = preference.over(rows)
    per = each(lambda b: [np.array([b[2].sum(), (b[1] == 0).sum(), (b[1] == 1).sum()])])
    assert len(per) > 3 and sum(p[0][0] for p in per) == 600
    assert all(p[0][1] >= min(zeros, 50) and p[0][2] > 0 for p in per)
    r, whole = preference.fit_buckets(each, 0.3), preference.fit(x, label, 0.3)
    assert np.allclose(r.mean, whole.mean) and np.allclose(r.scale, whole.scale)
    assert np.argmax(np.abs(r.weights)) == 3
    s = np.sort(r.raw(x))
    assert r.shift == pytest.approx((s[zeros - 1] + s[zeros]) / 2)


def test_ranks_among_many_and_equal_scores():
    rng = np.random.default_rng(3)
    for s in (rng.standard_normal(20_000), np.ones(5000), np.r_[np.zeros(3000), rng.random(9000)]):
        parts = [(p[:, None], np.zeros(len(p)), np.ones(len(p), dtype=bool)) for p in np.array_split(rng.permutation(s), 4)]
        each = lambda f: [f(p) for p in parts]
        for k in (0, 2999, len(s) - 2):
            got = preference.order_statistics(each, lambda x: x[:, 0], (k, k + 1))
            assert got == np.sort(s)[[k, k + 1]].tolist()

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import embeddings, queries


def plain(rows, threshold=0.93):
    """{position: (links, component)} by comparing all pairs."""
    n = len(rows)
    root = list(range(n))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    links = [0] * n
    ok = [
        v is not None and label is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for _, v, label in rows
    ]
    for label, dim in {(r[2], len(r[1])) for r, k in zip(rows, ok) if k}:
        at = [i for i in range(n) if ok[i] and rows[i][2] == label and len(rows[i][1]) == dim]
        x = np.array([rows[i][1] for i in at], dtype=np.float64)
        norm = np.linalg.norm(x, axis=1)
        for a, b in zip(*np.nonzero((x @ x.T) / np.outer(norm, norm) >= threshold)):
            if a != b:
                links[at[a]] += 1
                root[find(at[a])] = find(at[b])
    groups = {}
    for i in range(n):
        groups.setdefault(find(i), []).append(rows[i][0])
    return [(links[i], min(groups[find(i)])) for i in range(n)]


@pytest.mark.parametrize("leaf,block", [(768, 2048), (40, 30)])
def test_against_all_pairs(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(embeddings, "LEAF_ROWS", leaf)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(1)
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label")
    rows = [tuple(r) for r in table.collect()]
    # each vector has variants at cosines around the threshold
    for k in range(3):
        for i, v, label in rows[:500]:
            v = np.array(v)
            near = v + rng.uniform(0.1, 0.45) * np.linalg.norm(v) * rng.standard_normal(len(v)) / np.sqrt(len(v))
            rows.append((100_000 * (k + 1) + i, [float(x) for x in near], label))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r["vec_id"]: r for r in embeddings.near_duplicates(df).collect()}
    found = true = 0
    for (i, _, _), (n, _) in zip(rows, plain(rows)):
        assert got[i]["n_links"] <= n
        assert got[i]["kept"] == (got[i]["component_id"] == i)
        found, true = found + got[i]["n_links"], true + n
    assert true > 1000 and found >= 0.95 * true


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in queries.op6_embedding_near_dedup(spark, sf).collect()}
    assert got == {r[0]: x for r, x in zip(rows, plain(rows))}


def test_awkward_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "LEAF_ROWS", 16)
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    rng = np.random.default_rng(0)
    centre = rng.standard_normal(8)
    near = [(100 + i, [float(x) for x in centre + 0.02 * rng.standard_normal(8)], 1) for i in range(60)]
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, [1.0, 0.0], None),
        (6, [1.0, 0.0], None), (7, None, 1), (8, [], 1), (9, [0.0, 0.0], 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 1),
        (12, [None, 1.0], 1), (13, [1.0, 0.0, 0.0], 1), (14, [-1.0, 0.0], 1), (14, [-1.0, 0.0], 1), (15, [0.0, 1.0], 1), *near,
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.withColumns({"kept": F.lit("mine"), "id": F.lit(0), "v": F.lit(0), "n": F.lit(1)})
    got = sorted(map(tuple, embeddings.near_duplicates(df).collect()))
    want = sorted((r[0], n, c, r[0] == c) for r, (n, c) in zip(rows, plain(rows)))
    assert got == want
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_spilled_pairs_are_counted_once():
    codes = np.array([[1, 5, 9], [2, 5, 9], [5, -1, -1], [9, -1, -1]])
    i, j = np.array([0, 0, 0, 1]), np.array([1, 2, 3, 3])
    assert embeddings._counted_here(codes, i, j, 9).tolist() == [False, False, True, True]
    assert embeddings._counted_here(codes, i, j, 5).tolist() == [True, True, True, True]

"""Operator 2: recall against brute force, and awkward vectors."""

import numpy as np

from llm import nearest as N
from tests.llm.conftest import SF

KIND = "vec_id long, embedding array<float>, shard int"


def _exact(vectors: dict, i: int, k: int = 5):
    q = np.array(vectors[i], float)
    scores = [(-(np.dot(v, q) / (np.linalg.norm(v) * np.linalg.norm(q))), j) for j, v in ((j, np.array(v, float)) for j, v in vectors.items()) if j != i]
    return [(j, -s) for s, j in sorted((round(s, 12), j) for s, j in scores)[:k]]


def test_recall(spark):
    sf = SF.replace("0.001", "0.1")
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    got = {}
    for r in N.op2_collision_counting(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i in vectors if i % 50 == 0}
    hits = 0
    for i, found in got.items():
        exact = _exact(vectors, i)
        assert [r for r, _, _ in sorted(found)] == [1, 2, 3, 4, 5]
        assert [s for _, _, s in sorted(found)] == sorted((s for _, _, s in found), reverse=True)
        hits += len({j for j, _ in exact} & {j for _, j, _ in found})
        for _, j, s in found:
            a, b = np.array(vectors[i], float), np.array(vectors[j], float)
            assert abs(s - a @ b / (np.linalg.norm(a) * np.linalg.norm(b))) < 1e-12
    assert hits >= 0.9 * 5 * len(got)


def test_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "SHARD", 40)
    monkeypatch.setattr(N, "BLOCK_BYTES", 7 * 8 * 8)
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).tolist(), 0) for i in range(200)]
    df = spark.createDataFrame(rows, KIND)
    vectors = {r.vec_id: r.embedding for r in df.collect()}
    got = {}
    for r in N.nearest(df, df.filter("vec_id % 10 = 0")).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert len(got) == 20
    assert sum(len(got[i] & {j for j, _ in _exact(vectors, i)}) for i in got) >= 90


def test_awkward_vectors(spark):
    same = [1.0, 2.0]
    rows = [(i, same, i) for i in range(20)] + [(0, same, 99)]
    rows += [(50, None, 0), (51, [], 0), (52, [0.0, 0.0], 0), (53, [float("nan"), 1.0], 0), (54, [float("inf"), 1.0], 0), (55, [None, 1.0], 0),
             (100, [2.0, 1.0], 0), (150, [1.0, 2.0, 3.0], 0), (None, same, 0)]
    df = spark.createDataFrame(rows, KIND)
    got = {}
    for r in N.nearest(df, df.filter("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 9)))
    assert got[0] == [(k, k, 1.0) for k in range(1, 6)]  # ties go to smaller ids, equal rows are one
    assert got[100] == [(k + 1, k, 0.8) for k in range(5)]
    assert set(got) == {0, 100}  # a vector alone of its length finds nothing
    assert N.nearest(df.limit(0), df.limit(0)).count() == 0

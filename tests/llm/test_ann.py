"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from statflow.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_query, k=5):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for i in np.flatnonzero([is_query(v) for v in ids]):
        score = (x * x[i]).sum(axis=1) / (norm * norm[i])
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def vectors(n, d=24, seed=1):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, d))
    x = centers[rng.integers(12, size=n)] + rng.normal(size=(n, d)) * 0.7
    x[::3] = x[0]  # one very common vector
    return [(i, [float(v) for v in r], 0) for i, r in enumerate(x.astype(np.float32))]


@pytest.mark.parametrize("chunk", [64, 4096])
def test_recall(spark, monkeypatch, chunk):
    """Small chunks cut every list and its queries."""
    monkeypatch.setattr(ann, "CHUNK", chunk)
    monkeypatch.setattr(ann, "BOUND_SAMPLE", 50)
    rows = vectors(1500)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {}
    for r in ann.search(df, F.col("id") % 10 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(rows, lambda v: v % 10 == 0)
    assert set(got) == set(want)
    hits = 0
    for q, near in want.items():
        mine = sorted(got[q])
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert sorted(mine, key=lambda m: (-m[2], m[1])) == mine
        hits += len({v for v, _ in near} & {m[1] for m in mine})
        exact = dict(near)
        assert all(abs(m[2] - exact[m[1]]) < 1e-12 for m in mine if m[1] in exact)
    assert hits >= 0.9 * 5 * len(want)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (50, [0.0, 2.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 1.0], 1), (3, None, 1),
            (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [1.0, inf], 1), (7, [1.0, None], 1),
            (8, [1.0, 2.0, 3.0], 1), (100, [], 1), (None, [1.0, 0.0], 1), (1, [1.0, 1.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("rank", F.lit("y"))
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 6))
                 for r in ann.search(df, F.col("id") % 50 == 0).collect())
    half = round(0.5 ** 0.5, 6)
    assert got == [(0, 1, 1, half), (0, 2, 2, half), (0, 3, 50, 0.0),
                   (50, 1, 1, half), (50, 2, 2, half), (50, 3, 0, 0.0)]
    assert ann.search(df.limit(0), F.col("id") % 50 == 0).collect() == []
    one = spark.createDataFrame([(0, [1.0], 0)], SCHEMA)
    assert ann.search(one, F.col("id") % 50 == 0).collect() == []


def test_rotation_keeps_lengths_and_tests_keep_neighbours():
    turn = ann.rotation(32)
    assert np.allclose(turn @ turn.T, np.eye(32))
    rng = np.random.default_rng(3)
    block = ann.unit(rng.normal(size=(3000, 32)))
    queries = ann.unit(rng.normal(size=(60, 32)))
    far = ((block[None] - queries[:, None]) ** 2).sum(axis=2)
    kth = np.sort(far, axis=1)[:, 4]
    kept = sum(len(set(alive) & set(np.argsort(far[i])[:5])) for i, alive in
               ann.scan(queries, kth, block, 5))
    assert kept >= 0.95 * 5 * 60


def test_rows_come_from_the_scan(spark, monkeypatch):
    """With few probes and all vectors sampled, neighbours in other lists stay
    unfound, and every query still finds k."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(rng.normal(size=(900, 32)).astype(np.float32))]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {}
    for r in ann.search(df, F.col("id") % 30 == 0, probes=0.05).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(rows, lambda v: v % 30 == 0)
    assert {len(v) for v in got.values()} == {5} and set(got) == set(want)
    assert sum(len(got[q] & {v for v, _ in near}) for q, near in want.items()) < 0.8 * 5 * len(want)


def test_repeated_rows_push_no_neighbour_out(spark):
    """An id stands 12 times alike, another with 12 vectors."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(rng.normal(size=(60, 8)).astype(np.float32))]
    rows += [(200, [v * 1.01 for v in rows[0][1]], 0)] * 12
    rows += [(201, [v + 0.001 * j for v in rows[0][1]], 0) for j in range(1, 13)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [r.vec_id for r in ann.search(df, F.col("id") == 0, probes=1.0).orderBy("rank").collect()]
    near = brute(rows, lambda v: v == 0, k=60)[0]
    assert len(got) == len(set(got)) == 5
    assert got == list(dict.fromkeys(v for v, _ in near))[:5]

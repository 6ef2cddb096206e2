"""Clustering with bounds against a full scan in every round, and against DuckDB."""

import hashlib

import numpy as np
import pandas as pd
import pytest

import oracle
from modelspend.llm import op13_ns_clustering as O13
from modelspend.llm.registry import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


def full_scan(ids, points, k, rounds, seed=2):
    points = np.array(points, dtype=object)
    order = sorted(range(len(ids)), key=lambda i: (hashlib.sha256(f"{seed}:{'' if ids[i] is None else ids[i]}".encode()).hexdigest(), list(points[i])))
    centroids = [list(points[i]) for i in order[:k]]
    for step in range(rounds + 1):
        distances = [[sum((a - b) ** 2 for a, b in zip(p, c, strict=True)) for c in centroids] for p in points]
        cluster = [min(range(len(centroids)), key=lambda j: (d[j], j)) for d in distances]
        if step == rounds:
            return cluster, [d[c] for d, c in zip(distances, cluster, strict=True)], centroids
        for j in range(len(centroids)):
            own = [p for p, c in zip(points, cluster, strict=True) if c == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]


def test_query_equals_sql(spark, corpus):
    name = "op13_ns_clustering"
    with oracle.connect(corpus) as con:
        assert oracle.spark_rows(QUERIES[name](spark, corpus)) == oracle.duck_rows(con, ORACLE_SQL[name])


@pytest.mark.parametrize("spread", [3, 1 << 20])
def test_equals_a_full_scan(spark, spread):
    """Few whole numbers give many ties; large ones leave the doubles' exact range."""
    rng = np.random.default_rng(7)
    rows = [(i if i % 17 else None, [float(v) for v in rng.integers(-spread, spread, 4)]) for i in range(300)]
    rows += rows[:20]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS point", "2 AS cluster")
    found, centroids = O13.cluster_vectors(frame, k=9, rounds=6, dimensions=4, scale=3)
    points = [[int(v * 3) for v in e] for _, e in rows]
    cluster, distance, expected = full_scan([i for i, _ in rows], points, 9, 6)
    assert centroids.tolist() == expected
    got = sorted(((r.vec_id is None, r.vec_id or 0, r.cluster, r.distance) for r in found.collect()))
    assert got == sorted((i is None, i or 0, c, d) for (i, _), c, d in zip(rows, cluster, distance, strict=True))


def given():
    return np.floor(np.stack(pd.read_parquet(f"{SMALL}/embeddings.parquet").embedding) * 256.0).astype(np.int64)


def grouped():
    rng = np.random.default_rng(11)
    return rng.integers(-1000, 1000, (8, 16))[rng.integers(0, 8, 600)] + rng.integers(-20, 20, (600, 16))


@pytest.mark.parametrize(("points", "share"), [(given(), 0.8), (grouped(), 0.35)])
def test_bounds_spare_distances(points, share):
    centroids = points[:8]
    history, state = [centroids], O13.first_scan(points, centroids)
    scanned = 0
    for _ in range(8):
        cluster, _, bounds, seen = state
        means = [points[cluster == j].mean(0) if (cluster == j).any() else history[-1][j] for j in range(8)]
        history.append(np.floor(np.stack(means)).astype(np.int64))
        state = O13.rescan(points, cluster, bounds.astype(np.int64), seen, history, O13.displacements(history))
        exact = O13.all_squared(points, history[-1])
        assert (state[0] == exact.argmin(1)).all() and (state[1] == exact.min(1)).all()
        scanned += int((state[3] == len(history) - 1).sum())
    assert scanned < share * 8 * len(points) * 8


def test_loosened_bounds_hold():
    rng = np.random.default_rng(3)
    points = rng.integers(-200, 200, (500, 6))
    history = [rng.integers(-200, 200, (5, 6)) for _ in range(4)]
    moved = O13.displacements(history)
    for then, centroids in enumerate(history):
        bounds = O13.root_down(O13.all_squared(points, centroids)) - moved[then][None, :]
        now = O13.all_squared(points, history[-1])
        assert (np.maximum(bounds, 0) ** 2 <= now).all()


def test_unusable_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, []), (4, [1.0]), (5, [1.0, None]), (6, [1.0, float("nan")]), (7, [float("inf"), 1.0]), (8, [-0.4, 0.4])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found, centroids = O13.cluster_vectors(frame, k=40, rounds=2, dimensions=2, scale=1)
    assert sorted(r.vec_id for r in found.collect()) == [1, 8]
    assert sorted(centroids.tolist()) == [[-1, 0], [1, 2]]


def test_too_large_components_raise(spark):
    frame = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        O13.cluster_vectors(frame, k=1, rounds=1, dimensions=2, scale=1)

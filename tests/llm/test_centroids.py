"""Centroid clustering against plain Lloyd rounds in whole numbers."""

import hashlib
import math

import numpy as np
import pytest

from ouvidoria.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, v string, cluster int"


def nearest_by_hand(v, cs):
    return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cs))


def clusters_by_hand(rows, k, rounds, dims):
    kept = []
    for i, e in rows:
        if e is None or len(e) != dims or any(x is None or not math.isfinite(x) for x in e):
            continue
        kept.append((i, [math.floor(1024 * x) for x in e]))
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cs = [v for _, v in named[:k]]
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest_by_hand(v, cs)[1], []).append(v)
        cs = [[sum(c) // len(groups[j]) for c in zip(*groups[j], strict=True)] if j in groups else cs[j] for j in range(len(cs))]
    found = [(i, *nearest_by_hand(v, cs)) for i, v in kept]
    per = {j: sum(d for _, d, jj in found if jj == j) for j in range(len(cs))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cs]
    most = 2**63 - 1
    return sorted(((i, j, min(d, most), min(per[j], most), min(sum(per.values()), most), sha[j]) for i, d, j in found), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str)


def odd_vectors(dims, large=False):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=dims) / 3 + i % 4).round(3).tolist()) for i in range(200)]
    rows += [(i, rows[3][1]) for i in range(200, 240)] + [rows[5], rows[5], (7, rows[8][1]), (None, rows[9][1])]
    rows += [(300, None), (301, [1.0] * (dims - 1)), (302, [float("nan")] * dims), (303, [None] + [1.0] * (dims - 1)), (304, [])]
    rows += [(305, [float("inf")] + [0.0] * (dims - 1)), (306, [0.0] * dims), (307, [-0.0] * dims)]
    if large:
        rows += [(400, [1e9] * dims), (401, [-1e9] * dims), (402, [1e9, -1e9] * (dims // 2))]
    return rows


@pytest.mark.parametrize(("dims", "k", "large"), [(4, 8, False), (64, 8, False), (4, 3, True), (2, 1, False)])
def test_clusters(spark, dims, k, large):
    rows = odd_vectors(dims, large)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    assert result(centroids.clusters(df, k=k, dims=dims)) == clusters_by_hand(rows, k, 10, dims)


def test_few_or_no_vectors(spark):
    one = spark.createDataFrame([(1, [0.5, 0.25], "", 0), (2, [0.5, 0.25], "", 0)], SCHEMA)
    assert {(r.cluster, r.distance) for r in centroids.clusters(one, dims=2).collect()} == {(0, 0)}
    assert centroids.clusters(one.limit(0), dims=2).count() == 0
    assert centroids.clusters(one, dims=3).count() == 0
    nameless = spark.createDataFrame([(None, [0.5, 0.25], "", 0)], SCHEMA)
    assert centroids.clusters(nameless, dims=2).count() == 0


def test_inequalities_spare_exact_distances():
    rng = np.random.default_rng(1)
    means = rng.integers(-900, 900, 40)
    cs = (means[:, None] + rng.integers(-60, 60, (40, 64))).tolist()
    x = np.array([cs[i % 40] for i in range(2000)]) + rng.integers(-20, 20, (2000, 64))
    search = centroids.EqualAverageSearch(cs)
    owner, d = search.nearest(x.astype(float))
    want = [nearest_by_hand(v, cs) for v in x[:200].tolist()]
    assert [(int(b), int(a)) for a, b in zip(owner[:200], d[:200], strict=True)] == want
    assert search.exact < 2000 * 40 / 5

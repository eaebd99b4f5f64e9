import hashlib
import math
import random

import numpy as np
import pytest

from parcelmart.llm import centroids
from parcelmart.llm.centroids import LookupTables, cluster_vectors, inertias

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance int, vector int"


def kept(rows, dims, scale):
    out = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            out.append((i, [max(-(2**27), min(2**27, math.floor(scale * x))) for x in v]))
    return out


def brute(rows, k, rounds, dims, scale):
    rows = kept(rows, dims, scale)
    first = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    means = [v for _, v in first[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m, strict=True)), c) for c, m in enumerate(means))

    for _ in range(rounds):
        of = [nearest(v)[1] for _, v in rows]
        groups = [[v for (_, v), c in zip(rows, of, strict=True) if c == n] for n in range(len(means))]
        means = [[sum(col) // len(g) for col in zip(*g, strict=True)] if g else m for g, m in zip(groups, means, strict=True)]
    return sorted(((i, nearest(v)[1], nearest(v)[0]) for i, v in rows), key=str), means


def run(spark, rows, **options):
    got = cluster_vectors(spark.createDataFrame([(i, v, "c", 1, 2) for i, v in rows], SCHEMA).repartition(3), **options)
    return sorted((tuple(r) for r in got.rows.collect()), key=str), got


@pytest.mark.parametrize(("seed", "spread", "many"), [(0, 1, 4096), (1, 1000, 4096), (2, 1000, 5), (3, 0.01, 4096)])
def test_against_brute_force(spark, seed, spread, many, monkeypatch):
    monkeypatch.setattr(centroids, "KEPT_VALUES", many)
    r = random.Random(seed)
    rows = [(k, [r.gauss(0, spread) for _ in range(5)]) for k in range(300)] + [(300 + k, [0.5, -0.5, 1.0, 0.0, -1.0]) for k in range(150)]
    rows += [(7, [1.0] * 5), (7, [1.0] * 5), (None, [2.0] * 5), (500, None), (501, []), (502, [1.0] * 4), (503, [1.0, None, 0.0, 0.0, 0.0])]
    rows += [(504, [math.nan] + [0.0] * 4), (505, [math.inf] + [0.0] * 4), (506, [0.0] * 5)]
    got, clusters = run(spark, rows, k=6, rounds=3, dims=5, scale=64)
    want, means = brute(rows, 6, 3, 5, 64)
    assert got == want and clusters.centroids == means
    total = {c: sum(d for _, x, d in want if x == c) for c in {c for _, c, _ in want}}
    assert {r.cluster: (r.cluster_inertia, r.inertia, r.centroid) for r in inertias(clusters).collect()} == {c: (n, sum(total.values()), means[c]) for c, n in total.items()}


def test_few_equal_huge_and_no_vectors(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(k, [1.0, 2.0]) for k in range(9)], [(1, [1e30, -1e30]), (2, [-1e30, 1e30]), (3, [0.0, 0.0])]):
        got, clusters = run(spark, rows, k=4, rounds=2, dims=2, scale=64)
        want, means = brute(rows, 4, 2, 2, 64)
        assert got == want and clusters.centroids == means
        assert inertias(clusters).count() == len({c for _, c, _ in want})


def test_tables_hold_what_occurs():
    tables = LookupTables(np.array([[0, 0], [10, -3]]))
    for rows in ([[1, 2], [9, -3]], [[1, 2], [1, 2]], [[-5, 7], [5, 5]]):
        cluster, distance = tables.nearest(np.array(rows))
        exact = [[(a - x) ** 2 + (b - y) ** 2 for x, y in ((0, 0), (10, -3))] for a, b in rows]
        assert cluster.tolist() == [d.index(min(d)) for d in exact] and distance.tolist() == [min(d) for d in exact]
    assert tables.values[0].tolist() == [-5, 1, 5, 9] and len(tables.squares[1]) == len({2, -3, 7, 5})

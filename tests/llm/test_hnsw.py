import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelmart.llm.hnsw import Graph, nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, score double, dim int"


def near(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0.0, 1) for i, v in rows], SCHEMA)
    return nearest_neighbours(df, F.col("vec_id") % 10 == 0, **options)


def brute(rows, k):
    usable = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        usable[i] = min(usable.get(i, v), v)
    out = []
    for q, v in usable.items():
        if q % 10 == 0:
            others = sorted((math.dist(v, w), i) for i, w in usable.items() if i != q and len(w) == len(v))
            out += [(q, rank + 1, i, round(d, 9)) for rank, (d, i) in enumerate(others[:k])]
    return sorted(out)


def collect(df):
    return sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in df.collect())


def test_graph_reaches_nearly_all_nearest():
    points = np.random.default_rng(1).normal(size=(3000, 24))
    graph = Graph(points).build()
    found, near_ = graph.search(points[:200], 10, 200)
    exact = np.sqrt(((points[:200, None] - points[None]) ** 2).sum(2))
    assert (near_ <= np.sort(exact, 1)[:, 9:10] + 1e-12).mean() > 0.95
    assert all(len(set(row)) == 10 for row in found.tolist())
    for links in graph.links:
        for node, row in enumerate(links.tolist()):
            kept = [x for x in row if x >= 0]
            assert len(kept) == len(set(kept)) and node not in kept


def test_flat_form_gives_the_same_graph():
    points = np.random.default_rng(2).normal(size=(500, 8))
    graph = Graph(points).build()
    again = Graph.from_flat(points, *graph.flat(), graph.degree)
    assert all((a == b).all() for a, b in zip(graph.links, again.links, strict=True))
    assert (graph.search(points[:20], 5, 40)[0] == again.search(points[:20], 5, 40)[0]).all()


def test_small_shards_are_searched_whole_and_merged(spark):
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=4).astype(np.float32).tolist()) for i in range(120)]
    assert collect(near(spark, rows, shard_rows=30, block_rows=4)) == brute(rows, 10)


def test_shards_without_vectors_of_a_length_answer_nothing(spark):
    random = np.random.default_rng(4)
    rows = [(i, random.normal(size=3 if i % 20 == 0 else 4).astype(np.float32).tolist()) for i in range(140)]
    assert collect(near(spark, rows, shard_rows=5, block_rows=2)) == brute(rows, 10)


def test_ties_repeats_and_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(25)] + [(i, [1.0, float(i)]) for i in range(25, 32)]
    rows += [(40, None), (50, []), (60, [0.0, 0.0]), (70, [nan, 1.0]), (80, [inf, 1.0]), (90, [None, 1.0]), (None, [1.0, 2.0])]
    rows += [(100, [1.0, 1.0]), (100, [1.0, 1.0]), (100, [5.0, 5.0]), (110, [1.0, 2.0, 3.0]), (120, [3.0, 2.0, 1.0])]
    assert collect(near(spark, rows)) == brute(rows, 10)


@pytest.mark.parametrize("rows", [[], [(10, [1.0, 2.0])], [(1, [1.0, 2.0]), (3, [2.0, 1.0])]])
def test_nothing_to_find(spark, rows):
    assert collect(near(spark, rows)) == []


@pytest.mark.parametrize("far", [1e30, 1e-30, 1e200])
def test_a_huge_or_tiny_component_blinds_no_shard(far):
    points = np.random.default_rng(5).normal(size=(1500, 16))
    points[7] = 0.0
    points[7, 0] = far
    graph = Graph(points).build()
    _, near_ = graph.search(points[:100], 10, 128)
    exact = np.sort(np.sqrt(((points[:100, None] - points[None]) ** 2).sum(2)), 1)[:, :10]
    assert (near_ <= exact[:, 9:] * (1 + 1e-9)).mean() > 0.95


@pytest.mark.parametrize("clusters", [0, 40])
def test_recall_over_several_shards(spark, clusters):
    random = np.random.default_rng(6)
    points = random.normal(size=(4800, 24))
    if clusters:
        points = 0.1 * points + random.normal(size=(clusters, 24))[random.integers(0, clusters, len(points))]
    rows = [(i, v.tolist()) for i, v in enumerate(points.astype(np.float32))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = nearest_neighbours(df, F.col("vec_id") % 50 == 0, shard_rows=1000, search_beam=64).collect()
    exact = np.array([v for _, v in rows], np.float32).astype(np.float64)
    hits = 0
    for q in range(0, 4800, 50):
        d = ((exact - exact[q]) ** 2).sum(1)
        d[q] = np.inf
        hits += len({r.vec_id for r in got if r.query_id == q} & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert len(got) == 960 and hits >= 0.9 * 960

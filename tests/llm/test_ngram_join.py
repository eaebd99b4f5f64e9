import random
import re

import numpy as np
import pytest

from parcelmart.llm.graph import components
from parcelmart.llm.ngram_join import near_duplicates, one_of_each, similar_pairs, unshared

LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, n int, cls long, gone string"


def grams(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], SCHEMA)


def linked(a, b, percent):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def groups(rows, n, percent):
    sets = [grams(t, n) for _, t in rows]
    names = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j], percent):
                a, b = names[i], names[j]
                names = [min(a, b) if x in (a, b) else x for x in names]
    return sets, names


def expected(rows, n, percent):
    sets, names = groups(rows, n, percent)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[m][0] for m in range(len(rows)) if names[m] == names[k] and rows[m][0] is not None] if sets[k] else [i]
        out.append((i, len(sets[k]), min(ids, default=None)))
    return sorted(out, key=str)


def corpus(seed, size):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)]
    bases = [[r.choice(vocabulary) for _ in range(r.randint(1, 60))] for _ in range(6)]
    rows = []
    for k in range(size):
        words = list(r.choice(bases)) if r.random() < 0.8 else [r.choice(vocabulary) for _ in range(r.randint(1, 40))]
        for _ in range(r.choice([0, 0, 1, 1, 2, 6])):
            words[r.randrange(len(words))] = r.choice([*vocabulary, f"new{k}"])
        rows.append((k, " ".join(words)))
    return rows


@pytest.mark.parametrize("seed,n,percent", [(1, 3, 90), (2, 5, 80), (3, 1, 60), (4, 2, 100), (5, 3, 70)])
def test_components_against_brute_force(spark, seed, n, percent):
    rows = corpus(seed, 70)
    got = sorted(map(tuple, near_duplicates(frame(spark, rows), n, percent).collect()), key=str)
    assert got == expected(rows, n, percent)


def test_all_pairs_against_brute_force(spark):
    rows = corpus(9, 60)
    pairs, members = similar_pairs(frame(spark, rows), 2, 70)
    sets = [grams(t, 2) for _, t in rows]
    first = {s: min(i for i, t in rows if grams(t, 2) == s) for s in sets}
    want = {(first[a], first[b], len(a & b)) for a in first for b in first if first[a] < first[b] and linked(a, b, 70)}
    got = [(*sorted([r.a, r.b]), r.overlap) for r in pairs.collect()]
    assert set(got) == want and len(got) == len(want)
    assert sorted((r.doc_id, r.class_id) for r in members.collect()) == sorted((i, first[grams(t, 2)]) for i, t in rows)


EDGES = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A b"), (6, "a b c d e f"), (6, "a b c d e f"), (7, "x " * 5000),
    (8, "x " * 6000), (None, "a b"), (None, None), (None, "lone text of no id at all"), (9, "a b c d e f"), (9, "other words here stand now"),
]


def test_edges(spark):
    got = sorted(map(tuple, near_duplicates(frame(spark, EDGES), 3, 90).collect()), key=str)
    assert got == expected(EDGES, 3, 90)


def test_one_of_each_stays(spark):
    got = one_of_each(frame(spark, EDGES), 3, 90)
    assert got.columns == ["doc_id", "text", "n", "cls", "gone"]
    rows = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    sets, names = groups(EDGES, 3, 90)
    want = []
    for name in set(names):
        members = [EDGES[k] for k in range(len(EDGES)) if names[k] == name]
        best = min(members, key=lambda m: (m[0] is None, m[0] or 0))
        want.append(best)
    assert sorted((r[0] is None, r[0] or 0) for r in rows) == sorted((r[0] is None, r[0] or 0) for r in want)
    rows = corpus(4, 70)
    kept = {r.doc_id for r in one_of_each(frame(spark, rows), 2, 70).collect()}
    assert kept == {c for _, _, c in expected(rows, 2, 70)}


@pytest.mark.parametrize("span", [12, 60, 400])
def test_suffix_filter_bounds_what_is_not_shared(span):
    random = np.random.default_rng(span)
    runs = lambda: [np.sort(random.integers(0, span, random.integers(0, 60))).astype(np.uint64) for _ in range(200)]
    a, b = runs(), runs()
    a[:50] = [np.sort(np.delete(x, range(min(len(x), k % 3)))) for k, x in enumerate(b[:50])]  # nearly the same
    ends = lambda rows: np.concatenate([[0], np.cumsum([len(x) for x in rows])])
    count = lambda x: np.bincount(x.astype(int), minlength=span)
    true = np.array([np.abs(count(x) - count(y)).sum() for x, y in zip(a, b, strict=True)])
    ends_a, ends_b = ends(a), ends(b)
    found = [unshared(np.concatenate(a), ends_a[:-1], ends_a[1:], np.concatenate(b), ends_b[:-1], ends_b[1:], d) for d in range(9)]
    assert all((x <= true).all() for x in found) and all((x <= y).all() for x, y in zip(found, found[1:], strict=False))
    assert (found[0] == np.abs(np.diff(ends_a) - np.diff(ends_b))).all() and found[8].sum() > 0.95 * true.sum()


def test_empty_table(spark):
    assert near_duplicates(frame(spark, [])).collect() == [] and one_of_each(frame(spark, [])).collect() == []


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (1, 0)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)}

import random
import re

import pytest

from parcelmart.llm.decontaminate import find_leaks, without_leaks

LOWER = {i: i + 32 for i in range(65, 91)}
DOCS, ITEMS = "doc_id long, text string, item_id string, n_shared int", "item_id long, text string, doc_id string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def grams(w, n):
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute(docs, items, n, threshold):
    best = {}
    for i, t in items:
        w = words(t)
        own = grams(w, min(n, len(w))) if w else set()
        for d, u in docs:
            shared = len(own & grams(words(u), min(n, len(w)))) if own else 0
            if own and shared >= threshold * len(own) - 1e-9:
                best[(d, i)] = max(best.get((d, i), (0, 0, 0)), (shared / len(own), len(own), shared))
    return sorted(((d, i, n_, s, c) for (d, i), (c, n_, s) in best.items()), key=str)


def leaks(spark, docs, items, n=5, threshold=0.8, **options):
    found = find_leaks(
        spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS), spark.createDataFrame([(i, t, "y") for i, t in items], ITEMS), n, threshold, **options
    )
    assert found.columns == ["doc_id", "item_id", "n_shingles", "n_shared", "containment"]
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(50)]
    items = [(k, " ".join(r.choice(vocabulary) for _ in range(r.randint(1, 60)))) for k in range(15)]
    docs = []
    for k in range(60):
        text = [r.choice(vocabulary) for _ in range(r.randint(0, 200))]
        if r.random() < 0.7:
            item = r.choice(items)[1].split()
            for _ in range(r.choice([0, 0, 1, 2])):
                item[r.randrange(len(item))] = "changed"
            at = r.randint(0, len(text))
            text[at:at] = [w.upper() for w in item]
        docs.append((k, " ".join(text)))
    return docs, items


@pytest.mark.parametrize("seed,n,threshold,block", [(1, 5, 0.8, 10**6), (2, 3, 0.6, 60), (3, 1, 1.0, 100), (4, 5, 0.5, 100)])
def test_against_brute_force(spark, seed, n, threshold, block):
    docs, items = corpus(seed)
    assert leaks(spark, docs, items, n, threshold, block_shingles=block) == brute(docs, items, n, threshold)


def test_edges(spark):
    docs = [(1, None), (2, ""), (None, "a b c d e f"), (3, "A b\tc D e f"), (3, "x"), (3, "a b c d e"), (4, "z " * 50000 + "a b c d e f"), (5, "a\n b")]
    items = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b"), (3, None), (4, ""), (5, " \n"), (None, "d e f"), (6, "a b c d e q")]
    assert leaks(spark, docs, items) == brute(docs, items, 5, 0.8)
    assert leaks(spark, [], items) == [] and leaks(spark, docs, []) == []


def test_documents_without_leaks_stay(spark):
    docs, items = corpus(5)
    got = without_leaks(spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS), spark.createDataFrame([(i, t, "y") for i, t in items], ITEMS))
    bad = {d for d, *_ in brute(docs, items, 5, 0.8)}
    assert bad and sorted(r.doc_id for r in got.collect()) == [i for i, _ in docs if i not in bad]
    assert got.columns == ["doc_id", "text", "item_id", "n_shared"]


def test_only_rows_whose_own_text_leaks_go(spark):
    leak, clean = "one two three four five six", "nothing of the kind is in here"
    docs = [(None, leak), (None, clean), (None, None), (7, leak), (7, clean), (7, None), (8, clean)]
    got = without_leaks(spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS), spark.createDataFrame([(1, leak, "y")], ITEMS))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(((i, t) for i, t in docs if t != leak), key=str)

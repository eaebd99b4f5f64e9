import hashlib
import random
import zlib
from collections import defaultdict
from heapq import heapify, heapreplace

import pytest
from pyspark.sql import functions as F

from parcelmart.llm import sharding
from parcelmart.llm.sharding import assign_shards, place, shard_loads

DOCS = "doc_id long, shard string, text string, size int, key long, row string, slot int"


def brute(sizes, shards):
    """Shards of single groups, largest first, through a heap."""
    heap = [(0, s) for s in range(shards)]
    heapify(heap)
    out = []
    for size in sizes:
        load, shard = heap[0]
        out.append(shard)
        heapreplace(heap, (load + size, shard))
    return out, sorted(heap)


@pytest.mark.parametrize("seed", range(30))
def test_rounds_are_the_heap_over_single_groups(seed):
    r = random.Random(seed)
    shards = r.choice([1, 2, 3, 8, 13])
    counts = {r.randint(1, 10 ** r.randint(0, 6)): r.randint(1, 3 ** r.randint(0, 6)) for _ in range(r.randint(1, 60))}
    falling = sorted(counts.items(), reverse=True)
    heap, got = [(0, s) for s in range(shards)], []
    for size, count in falling:
        rounds = place(heap, size, count)
        assert rounds[0][0] == 0 and len(rounds) <= 2 * shards + 1
        for k in range(count):
            first, turn = [x for x in rounds if x[0] <= k][-1]
            got.append(turn[(k - first) % len(turn)])
    want, loads = brute([size for size, count in falling for _ in range(count)], shards)
    assert got == want and sorted(heap) == loads


def check(rows, got, shards):
    """The whole result against single groups on a heap."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    sizes = {t: len(ids) * (len(t.encode()) + 1) for t, ids in groups.items()}
    order = sorted(groups, key=lambda t: (-sizes[t], hashlib.sha256(t.encode()).digest()))
    shard_of = dict(zip(order, brute([sizes[t] for t in order], shards)[0], strict=True))
    want = sorted(((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), shard_of[t or ""]) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard) for r in got), key=str) == want
    for shard in range(shards):
        slots = sorted((r.slot, r.doc_id) for r in got if r.shard == shard)
        assert [s for s, _ in slots] == list(range(len(slots)))
        ids = [-(10**9) if i is None else i for _, i in slots]
        assert ids == sorted(ids)


def frame(spark, rows):
    return spark.createDataFrame([(i, "x", t, 7, 1, "r", 2) for i, t in rows], DOCS)


@pytest.mark.parametrize("seed", range(3))
def test_assignment(spark, seed, monkeypatch):
    monkeypatch.setattr(sharding, "SIZES_AT_ONCE", 5)
    r = random.Random(seed)
    texts = [None, "", "é" * r.randint(1, 9), "long " * 20000] + ["w" * r.randint(1, 12) + str(r.randint(0, 9)) for _ in range(60)]
    rows = [(k, r.choice(texts)) for k in range(300)] + [(300 + k, "the copy") for k in range(150)]
    rows += [(None, "no id"), (None, "no id"), (None, None), (5, "again"), (5, "again"), (5, "other")]
    got = assign_shards(frame(spark, rows), 5)
    assert got.columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    check(rows, got.collect(), 5)


def test_edges(spark):
    assert assign_shards(frame(spark, [])).collect() == []
    check([(1, None)], assign_shards(frame(spark, [(1, None)]), 3).collect(), 3)
    same = [(k, "all alike") for k in range(40)]
    check(same, assign_shards(frame(spark, same), 4).collect(), 4)
    with pytest.raises(ValueError):
        assign_shards(frame(spark, same), 0)


def test_balance_and_no_group_in_one_task(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("string"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int"))).alias("text"))
    loads = {r.shard: (r.n_rows, r.bytes) for r in shard_loads(assign_shards(docs, 8)).collect()}
    assert len(loads) == 8 and sum(n for n, _ in loads.values()) == 6000
    assert max(b for _, b in loads.values()) - min(b for _, b in loads.values()) <= 40

import random
import re

import pytest
from pyspark.sql import functions as F

from parcelmart.llm import line_dedup
from parcelmart.llm.line_dedup import dedup_lines, repeated_lines

SCHEMA = "doc_id long, text string, line int, gone_lines string, version long"


def tokens(line, n):
    w = [w for w in re.split(r"[\x20\x09-\x0D]+", line.lower()) if w]
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA)


def brute(rows, percent, n=5):
    """Numbers of the lines that go, for distinct (id, text)."""
    lines = []
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        lines += [((i is not None, i or 0), k, (i, t), tokens(x, n)) for k, x in enumerate((t or "").split("\n"))]
    lines.sort(key=lambda x: (x[0], x[1]))
    gone = set()
    for k, (_, n, row, a) in enumerate(lines):
        for _, _, _, b in lines[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                gone.add((row, n))
                break
    return gone


def corpus(seed, size):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)]
    bases = [[r.choice(vocabulary) for _ in range(r.randint(1, 25))] for _ in range(8)]
    rows = []
    for k in range(size):
        lines = []
        for _ in range(r.randint(0, 6)):
            line = list(r.choice(bases)) if r.random() < 0.7 else [r.choice(vocabulary) for _ in range(r.randint(0, 20))]
            if line and r.random() < 0.6:
                line[r.randrange(len(line))] = r.choice([*vocabulary, f"new{k}"])
            lines.append(" ".join(line))
        rows.append((k, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed,percent,shingle", [(1, 80, 5), (2, 60, 2), (3, 100, 5), (4, 80, 1), (5, 60, 3)])
def test_against_brute_force(spark, seed, percent, shingle):
    rows = corpus(seed, 40)
    got = {(r.doc_id, r.line) for r in repeated_lines(frame(spark, rows), percent, shingle).collect()}
    assert got == {(row[0], n) for row, n in brute(rows, percent, shingle)}


@pytest.mark.parametrize("least,percent,shingle", [(1, 60, 1), (3, 80, 2)])
def test_common_tokens_of_many_levels(spark, monkeypatch, least, percent, shingle):
    monkeypatch.setattr(line_dedup, "LEAST_COMMON", least)
    rows = corpus(6, 40)
    got = {(r.doc_id, r.line) for r in repeated_lines(frame(spark, rows), percent, shingle).collect()}
    assert got == {(row[0], n) for row, n in brute(rows, percent, shingle)}


def test_common_tokens_stand_behind_rare_ones_by_count(spark):
    levels = bytearray(line_dedup.RARE * (1 << line_dedup.CELL_BITS))
    keys = [k << (64 - line_dedup.CELL_BITS) for k in range(1, 7)]  # in cells 1 to 6
    for cell, level in ((1, b"3"), (2, b"1"), (4, b"3"), (5, b"A")):
        levels[cell : cell + 1] = level
    row = spark.createDataFrame([(keys,)], "keys array<long>").select(line_dedup._common_last(F.col("keys"), bytes(levels)).alias("keys")).first()
    assert [k >> (64 - line_dedup.CELL_BITS) for k in row["keys"]] == [3, 6, 2, 1, 4, 5]


EDGES = [
    (3, "One two  three\n\nfour FIVE"), (1, None), (2, ""), (4, "four five\none\ttwo\vthree\r\n \n\t\n"), (5, "four five\none\ttwo\vthree\r\n \n\t\n"),
    (5, "four five\none\ttwo\vthree\r\n \n\t\n"), (None, " one two three\nnull only"), (6, "x y z " * 20000 + "\nNULL ONLY"), (7, "z x y z x y z x y\t"),
]


def test_edges_and_text_without_the_lines(spark):
    gone = brute(EDGES, 80)
    got = dedup_lines(frame(spark, EDGES))
    assert got.columns == ["doc_id", "text", "line", "gone_lines", "version"]
    want = []
    for row in EDGES:
        kept = None if row[1] is None else "\n".join(x for n, x in enumerate(row[1].split("\n")) if (row, n) not in gone)
        want.append((row[0], kept))
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert repeated_lines(frame(spark, [])).collect() == [] and dedup_lines(frame(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    df = dedup_lines(frame(spark, EDGES))
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


def test_rows_without_an_id_are_documents_of_their_own(spark):
    text = "one two three\n\nfour five"
    rows = [(None, text), (None, text), (None, text), (None, "other words"), (None, None), (None, None), (1, "four five\nsix"), (1, "four five\nsix")]
    got = sorted(((r.doc_id, r.text) for r in dedup_lines(frame(spark, rows)).collect()), key=str)
    want = [(None, text), (None, ""), (None, ""), (None, "other words"), (None, None), (None, None), (1, "six"), (1, "six")]
    assert got == sorted(want, key=str)


def test_whole_sets_are_made_only_of_lines_that_may_be_similar(spark, monkeypatch):
    read, sets = [], line_dedup._Lines._sets

    def counted(self, lines, name):
        read.append(lines.count())
        return sets(self, lines, name)

    monkeypatch.setattr(line_dedup._Lines, "_sets", counted)
    half = " ".join(f"both{k}" for k in range(12))
    rows = [(i, half + "".join(f" own{i}x{k}" for k in range(12))) for i in range(20)]  # one third alike
    near = [f"near{k}" for k in range(24)]
    rows += [(30, " ".join(near)), (31, " ".join([*near[:-1], "other"]))]
    got = {(r.doc_id, r.line) for r in repeated_lines(frame(spark, rows), 60, 1).collect()}
    assert got == {(31, 0)} == {(row[0], n) for row, n in brute(rows, 60, 1)}
    assert sum(read) == 2


def test_parities_of_all_parts(spark):
    r = random.Random(7)
    bounds = [-(1 << 63), -(1 << 62) - 1, -(1 << 62), -1, 0, (1 << 62) - 1, 1 << 62, (1 << 63) - 1]
    sets = [sorted({r.randrange(-(1 << 63), 1 << 63) for _ in range(n)}) for n in (1, 2, 40, 500)] + [bounds, [0], [-(1 << 62), 1 << 62], [5]]
    df = spark.createDataFrame([(k, keys) for k, keys in enumerate(sets)], "id int, keys array<long>")
    got = {x["id"]: [x[p] & (2**64 - 1) for p in line_dedup.PARITY] for x in line_dedup._with_parities(df).collect()}
    for k, keys in enumerate(sets):
        want = [0, 0, 0, 0]
        for key in keys:
            want[(key + (1 << 63)) >> 62] ^= 1 << (key & 63)
        assert got[k] == want

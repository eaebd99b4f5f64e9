import random

import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from parcelmart.llm.common import table
from parcelmart.llm import quality
from parcelmart.llm.quality import fit_quality, remainder, score_quality

DOCS = "doc_id long, text string, label int, key long, ids string"
SF = "/root/testdata/sf0.01"


def corpus(size):
    r = random.Random(2)
    good, bad = [f"word{k}" for k in range(50)], [f"JUNK{k}$$" for k in range(50)]
    return [(k, " ".join(r.choice(bad if k % 4 == 0 else good) for _ in range(r.randint(3, 60))), int(k % 4 > 0)) for k in range(size)]


def scores(spark, rows, labels, **options):
    docs = spark.createDataFrame([(i, t, 0, 5, "x") for i, t in rows], DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, text string")
    got = score_quality(docs, marks, F.lit(True), ["doc_id", "ids"], epochs=12, **options)
    assert got.columns == ["doc_id", "ids", "quality_score"]
    return sorted(((r.doc_id, r.quality_score) for r in got.collect()), key=str)


def test_learns_and_generalises(spark):
    rows = corpus(400)
    got = dict(scores(spark, [r[:2] for r in rows], [(i, q, "t") for i, _, q in rows if i < 200]))
    right = [(got[i] >= 0.5) == bool(q) for i, _, q in rows if i >= 200]
    assert sum(right) >= 0.97 * len(right) and all(0 <= x <= 1 for x in got.values())


def test_edges(spark):
    rows = [r[:2] for r in corpus(40)] + [(100, None), (101, ""), (102, " \n"), (None, "word1 word2"), (0, "word1"), (103, "word3 " * 100000)]
    labels = [(i, q, "t") for i, _, q in corpus(40)] + [(1, 1, "t"), (1, 1, "t"), (1, 0, "t"), (None, 1, "t"), (5, None, "t"), (6, 7, "t"), (999, 0, "t")]
    got = scores(spark, rows, labels)
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s in got)
    assert dict(got)[100] == dict(got)[101]
    assert got == scores(spark, rows, labels)


def test_without_labels_or_rows(spark):
    assert scores(spark, [(1, "a"), (2, None)], []) == [(1, 0.5), (2, 0.5)]
    assert scores(spark, [], [(1, 1, "t")]) == []
    assert all(s > 0.5 for _, s in scores(spark, [(1, "a b"), (2, "c")], [(1, 1, "t"), (2, 1, "t")]))


def test_held_out_documents(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    got = score_quality(docs, labels, remainder(F.col("key"), 3) != 1, ["doc_id"])
    held = got.join(labels, "doc_id").filter(remainder(F.col("doc_id"), 3) == 1)
    right = held.agg(F.avg(((F.col("quality_score") >= 0.5) == (F.col("quality") == 1)).cast("int"))).first()[0]
    assert right > 0.95


def test_text_among_the_kept_columns(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = score_quality(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), F.lit(True), ["text", "doc_id"], "quality")
    assert got.columns == ["text", "doc_id", "quality"] and sorted((r.doc_id, r.text) for r in got.collect()) == [(1, "a b"), (2, None)]


def test_an_id_of_very_many_rows_brings_no_more_than_the_sample(spark):
    rows = [(1, "word1 word2"), (2, "JUNK1$$")] * 50 + [(3, f"word{k}") for k in range(200)] + [(7, None), (None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 0), (7, 1), (900, 1)], "doc_id long, quality int")
    seen = []

    def spy(settings):
        def count(batches):
            n = sum(batch.num_rows for batch in batches)
            yield pa.record_batch([pa.array([str(n).encode()], pa.binary())] * 3, names=["vectors", "out", "bias"])

        seen.append(settings)
        return count

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(quality, "_fit", spy)
        counts = [int(bytes(fit_quality(docs, marks, F.lit(True), sample=n).first()[0])) for n in (30, 1000)]
    assert counts == [30, 1 + 1 + 2 * 200 + 1] and len(seen) == 2  # copies count once, ids without a document not at all

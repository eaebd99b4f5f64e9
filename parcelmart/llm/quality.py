"""Quality classifier: supervised subword embeddings.

Every word, every pair of neighbouring words and every run of two and three bytes has a learned
vector, found by hashing. A document is the mean of the vectors of all its features and of a few
zero vectors, which keep very short texts near the prior; a softmax layer turns the mean into class
probabilities. Training is stochastic gradient descent in numpy on a bounded sample of labelled
documents; scoring covers every whole text in its tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from parcelmart.llm.common import mapped
from parcelmart.llm.words import runs, word_hashes, word_spans

BUCKETS = 1 << 16  # rows of the vector table for words, for byte pairs, byte triples and word pairs
PAIR, TRIPLE, WORD_PAIR, ROWS = BUCKETS, 2 * BUCKETS, 3 * BUCKETS, 4 * BUCKETS
ZEROS = 32
RUN_BYTES = 1 << 19  # features take some sixty bytes for each byte of text
SCORED = "scored text"


def _features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature, its row) for words, word pairs, byte pairs and triples, none of which crosses rows.
    A word pair is hashed by the exclusive or of its words, so all repeated words share a vector."""
    starts, ends, first_word = word_spans(data, offsets)
    rows = np.arange(len(offsets) - 1)
    words, row = word_hashes(data, starts, ends), np.repeat(rows, np.diff(first_word))
    yield (words >> np.uint64(48)).astype(np.int32), row
    same = row[:-1] == row[1:]
    yield WORD_PAIR + ((words[:-1] ^ words[1:])[same] >> np.uint64(48)).astype(np.int32), row[:-1][same]
    row = np.repeat(rows, np.diff(offsets))
    wide = data.astype(np.uint32)
    pairs = (wide[:-1] << 8) | wide[1:]
    same = row[:-1] == row[1:]
    yield PAIR + pairs[same].astype(np.int32), row[:-1][same]
    triples = ((((pairs[:-1] << 8) | wide[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int32)
    same = row[:-2] == row[2:]
    yield TRIPLE + triples[same], row[:-2][same]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each row its key, label and distinct features with counts."""
    for batch in batches:
        for first, end, data, offsets in runs(batch.column(2), RUN_BYTES):
            feature, row = (np.concatenate(x) for x in zip(*_features(data, offsets), strict=True))
            key, n = np.unique(row.astype(np.int64) * ROWS + feature, return_counts=True)
            bounds = np.searchsorted(key, np.arange(end - first + 1) * ROWS)
            ids = (key % ROWS).astype(np.int32)
            weights = n.astype(np.float32)
            pieces = [slice(bounds[k], bounds[k + 1]) for k in range(end - first)]
            yield pa.record_batch(
                [
                    batch.column(0).slice(first, end - first),
                    batch.column(1).slice(first, end - first),
                    pa.array([ids[p].tobytes() for p in pieces], pa.binary()),
                    pa.array([weights[p].tobytes() for p in pieces], pa.binary()),
                ],
                names=["key", "label", "ids", "counts"],
            )


def train(
    examples: list[tuple[np.ndarray, np.ndarray, int]], size: int = 16, epochs: int = 8, rate: float = 1.0, seed: int = 7
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vectors, output weights, bias) by stochastic gradient descent over (ids, counts, label 0 or
    1), with a linearly falling rate. Each class counts by its share, so scores stay calibrated."""
    random = np.random.default_rng(seed)
    vectors = ((random.random((ROWS, size)) - 0.5) / size).astype(np.float32)
    out, bias = np.zeros((size, 2), np.float32), np.zeros(2, np.float32)
    share = np.bincount([label for _, _, label in examples], minlength=2) / len(examples)
    bias[:] = np.log(np.maximum(share, 1e-3))
    steps = epochs * len(examples)
    step = 0
    for _ in range(epochs):
        for k in random.permutation(len(examples)):
            ids, counts, label = examples[k]
            now = rate * (1 - step / steps)
            step += 1
            if len(ids):
                weight = counts / (counts.sum() + ZEROS)
                mean = weight @ vectors[ids]
            else:
                mean = np.zeros(size, np.float32)
            logits = mean @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            if len(ids):
                back = out @ p
                scale = min(1.0, 1.0 / float(np.abs(back).max() + 1e-6))
                vectors[ids] -= np.outer(weight * (now * scale * len(ids) ** 0.5), back).astype(np.float32)
                out -= (now * np.outer(mean, p)).astype(np.float32)
            bias -= (0.1 * now * p).astype(np.float32)
    return vectors, out, bias


SIZE = 16  # components of a vector


def _fit(settings: dict) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            for key, label, ids, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows.append((key, label, ids, counts))
        rows.sort(key=lambda r: (r[0], r[1], r[2]))  # the order in which rows arrive does not matter
        if rows:
            made = train([(np.frombuffer(i, np.int32), np.frombuffer(c, np.float32), label) for _, label, i, c in rows], **settings)
            yield pa.record_batch([pa.array([x.astype(np.float32).tobytes()], pa.binary()) for x in made], names=["vectors", "out", "bias"])

    return fit


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def fit_quality(
    docs: DataFrame, labels: DataFrame, usable: Column, sample: int = 4000, size: int = SIZE, epochs: int = 8, rate: float = 1.0
) -> DataFrame:
    """The model (vectors, out, bias: float32 bytes) fitted on at most ``sample`` examples, the pairs of a different
    text of a labelled document that is ``usable`` and its label with the smallest hash; no row without any. Labels
    other than 0 and 1 and labels of ids that no document has are left out; an id with both labels is an example of
    both. Repeated rows are one example, so an id with very many rows brings no more than ``sample`` of them."""
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("key"), F.col("quality").cast("int").alias("label"))
        .filter(usable)
        .filter("key is not null and label in (0, 1)")
        .distinct()
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    texts = texts.filter("key is not null").withColumn("code", F.xxhash64("text"))
    wanted = (
        texts.select("key", "code")
        .distinct()
        .join(marks, "key")
        .orderBy(F.xxhash64("key", "code", F.lit(42)), "key", "code", "label")
        .limit(sample)
    )
    examples = (
        texts.join(F.broadcast(wanted), ["key", "code"])  # at most `sample` rows of three numbers
        .groupBy("key", "code", "label")
        .agg(F.first("text").alias("text"))
        .select("key", "label", "text")
        .mapInArrow(_counted, "key long, label int, ids binary, counts binary")
    )
    settings = {"size": size, "epochs": epochs, "rate": rate}
    return examples.repartition(1).mapInArrow(_fit(settings), "vectors binary, out binary, bias binary")


def _projected(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """mean(vectors) @ out = mean(vectors @ out), and with two classes the softmax needs the difference only:
    one number per feature is all that scoring takes."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                vectors, out, bias = (np.frombuffer(x, np.float32) for x in row)
                vectors, out = vectors.reshape(ROWS, size), out.reshape(size, 2)
                table = vectors @ (out[:, 1] - out[:, 0])
                yield pa.record_batch(
                    [pa.array([table.tobytes()], pa.binary()), pa.array([float(bias[1] - bias[0])])], names=["weights", "bias"]
                )

    return project


def _score(model, at: int, name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, bias = model.value
        for batch in batches:
            logits = np.zeros(batch.num_rows)
            for first, end, data, offsets in runs(batch.column(at), RUN_BYTES):
                total, n = np.zeros(end - first), np.zeros(end - first)
                for feature, row in _features(data, offsets):
                    total += np.bincount(row, table[feature], minlength=end - first)
                    n += np.bincount(row, minlength=end - first)
                logits[first:end] = total / (n + ZEROS)
            p = 1 / (1 + np.exp(-np.clip(logits + bias, -500, 500)))
            kept = [k for k, column in enumerate(batch.schema.names) if column != SCORED]
            yield pa.record_batch([*(batch.column(k) for k in kept), pa.array(p)], names=[*(batch.schema.names[k] for k in kept), name])

    return score


def score_quality(
    docs: DataFrame, labels: DataFrame, usable: Column, keep: list[str], name: str = "quality_score", **settings
) -> DataFrame:
    """The ``keep`` columns of every row and, under ``name``, the probability of label 1.

    Empty and null texts have no features: they get the share that label 1 has by the bias alone.
    Repeated rows score alike; every row gives one row. Without any usable label every score is
    0.5. Columns beyond ``keep`` may have any name.
    """
    model = fit_quality(docs, labels, usable, **settings).mapInArrow(_projected(settings.get("size", SIZE)), "weights binary, bias double").first()
    if model is None:
        return docs.select(*keep, F.lit(0.5).alias(name))
    table = np.frombuffer(model.weights, np.float32).astype(np.float64)
    sent = docs.sparkSession.sparkContext.broadcast((table, model.bias))  # of a fixed size
    rows = docs.select(*keep)
    schema = StructType([*rows.schema, StructField(name, DoubleType())])
    if "text" in keep and rows.schema["text"].dataType == StringType():
        return mapped(rows, _score(sent, keep.index("text"), name), schema)
    return mapped(docs.select(*keep, F.col("text").cast("string").alias(SCORED)), _score(sent, len(keep), name), schema)

"""Language identification by string kernels.

The blended-spectrum presence kernel of two texts counts the distinct runs of one to three bytes
(lower-cased) that both hold, over the square root of the product of their own counts. Runs are
hashed to a presence vector, so the kernel of many texts with the landmarks is one matrix
product. Nystroem features from the landmarks go into one-versus-rest ridge regression; a text
gets the language with the highest output.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from parcelmart.llm.common import mapped
from parcelmart.llm.words import text_bytes

BITS = 1 << 14
CHUNK = 256  # texts in one matrix product
CHUNK_BYTES = 1 << 20

_ASCII_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column)


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Presence vectors of the byte runs of each row, as 0 and 1 in float32."""
    n = len(offsets) - 1
    seen = np.zeros(n * BITS, np.float32)
    base = np.repeat(np.arange(n, dtype=np.int64) * BITS, np.diff(offsets))
    wide = data.astype(np.uint32)
    seen[base + wide] = 1
    code = wide
    for k in (1, 2):
        code = (code[:-1] << 8) | wide[k:]
        same = base[: len(code)] == base[k:]
        hashed = ((code * np.uint32(0x85EBCA6B)) ^ np.uint32(k * 0x27D4EB2F)) * np.uint32(0x9E3779B1)
        seen[(base[: len(code)] + (hashed >> np.uint32(18)))[same]] = 1
    return seen.reshape(n, BITS)


def chunks(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    data, offsets = text_bytes(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        end = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        end = min(max(end, first + 1), rows, first + CHUNK)
        yield first, end, presence(data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first])
        first = end


def normalised_kernel(x: np.ndarray, landmarks: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Kernel values of presence vectors with the landmarks (own: the landmarks' own counts)."""
    both = x @ landmarks.T
    return both / np.sqrt(np.maximum(x.sum(1), 1)[:, None] * np.maximum(own, 1)[None, :])


def train(x: np.ndarray, labels: list[str], landmarks: int, ridge: float) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, landmark vectors, weights): kernel values @ weights are the outputs by language."""
    languages = sorted(set(labels))
    target = np.array([[float(a == b) for b in languages] for a in labels])
    seen = dict.fromkeys(languages, 0)
    ranked = []
    for k, label in enumerate(labels):
        ranked.append((seen[label], label, k))
        seen[label] += 1
    chosen = [k for _, _, k in sorted(ranked)[:landmarks]]  # the languages in turn
    picked = x[chosen]
    own = picked.sum(1)
    values, axes = np.linalg.eigh(normalised_kernel(picked, picked, own).astype(np.float64))
    good = values > 1e-6 * values.max()
    half = axes[:, good] / np.sqrt(values[good])
    features = normalised_kernel(x, picked, own) @ half
    features = np.hstack([features, np.ones((len(x), 1))])
    penalty = ridge * np.eye(features.shape[1])
    penalty[-1, -1] = 1e-9  # the constant is not shrunk
    solved = np.linalg.solve(features.T @ features + penalty, features.T @ target)
    return languages, picked, np.vstack([half @ solved[:-1], solved[-1:]])


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lowered = _lower(batch.column(2).fill_null(""))
        for first, end, seen in chunks(lowered):
            packed = np.packbits(seen.astype(bool), axis=1)
            yield pa.record_batch(
                [
                    batch.column(0).slice(first, end - first),
                    batch.column(1).slice(first, end - first),
                    pa.array([row.tobytes() for row in packed], pa.binary()),
                ],
                names=["key", "lang", "seen"],
            )


def _fit(landmarks: int, ridge: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(
            (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)),
            key=lambda r: (r[0], r[1], r[2]),
        )
        if rows:
            random = np.random.default_rng(11)
            rows = [rows[k] for k in random.permutation(len(rows))]
            x = np.unpackbits(np.array([np.frombuffer(r[2], np.uint8) for r in rows]), axis=1).astype(np.float32)
            languages, picked, weights = train(x, [r[1] for r in rows], landmarks, ridge)
            yield pa.record_batch(
                [
                    pa.array([languages], pa.list_(pa.string())),
                    pa.array([np.packbits(picked.astype(bool), axis=1).tobytes()], pa.binary()),
                    pa.array([weights.astype(np.float64).tobytes()], pa.binary()),
                ],
                names=["languages", "landmarks", "weights"],
            )

    return fit


def _predict(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, packed, weights = model.value
        picked = np.unpackbits(np.frombuffer(packed, np.uint8).reshape(-1, BITS // 8), axis=1).astype(np.float32)
        own = picked.sum(1)
        weights = np.frombuffer(weights, np.float64).reshape(len(picked) + 1, len(languages)).astype(np.float32)
        names = np.array([*languages, "und"], dtype=object)
        for batch in batches:
            column = batch.column(batch.num_columns - 1).fill_null("")
            best, score = np.empty(len(column), np.int64), np.empty(len(column))
            for first, end, seen in chunks(_lower(column)):
                outputs = normalised_kernel(seen, picked, own) @ weights[:-1] + weights[-1]
                best[first:end] = outputs.argmax(1)
                score[first:end] = np.clip(outputs.max(1), 0, 1)
            data, offsets = text_bytes(column)
            letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[data[offsets[0] : offsets[-1]]], dtype=np.int64)])
            none = np.flatnonzero(np.diff(letters[offsets - offsets[0]]) == 0)
            for k in none:
                if not any(map(str.isalpha, column[int(k)].as_py())):
                    best[k], score[k] = len(languages), 0.0
            yield pa.record_batch(
                [*batch.columns[:-1], pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                names=[*batch.schema.names[:-1], "lang_pred", "lang_score"],
            )

    return predict


def identify_language(
    docs: DataFrame, usable: Column, keep: list[str], sample: int = 2000, landmarks: int = 96, ridge: float = 0.1
) -> DataFrame:
    """The ``keep`` columns of every row, lang_pred and lang_score.

    The model is fitted on at most ``sample`` different (id, language, text) that are ``usable``, the
    same number of each language as far as there are so many, those with the smallest hash of id and
    text; repeated rows are one of them. With more languages than ``sample`` only that many are learned. Null texts and texts without a letter are ``und`` with score 0; so are all
    without any row to learn from. Repeated rows are predicted alike; every row gives one row.
    Columns beyond ``keep`` may have any name.
    """
    labelled = (
        docs.filter(usable)
        .select(F.col("doc_id").cast("long").alias("key"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
        .filter("lang is not null and text is not null")
    )
    languages = labelled.select("lang").distinct().count()
    rows = docs.select(*keep, F.col("text").cast("string").alias("scored_text"))
    if not languages:
        return rows.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("lang_score"))
    each = max(1, sample // languages)
    labelled = labelled.withColumn("code", F.xxhash64("text"))
    drawn = labelled.select("key", "lang", "code").distinct().withColumn("draw", F.xxhash64("key", "code"))
    part = drawn.withColumn("part", F.pmod("draw", F.lit(16)))
    for by in (["lang", "part"], ["lang"]):  # a language's rows are cut in 16 parts before they meet
        ranks = Window.partitionBy(*by).orderBy("draw", "key", "code")
        part = part.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= each)
    wanted = part.orderBy("rank", "draw", "lang", "key", "code").limit(sample).select("key", "lang", "code")
    examples = (
        labelled.join(F.broadcast(wanted), ["key", "lang", "code"])  # at most `sample` rows
        .groupBy("key", "lang", "code")
        .agg(F.first("text").alias("text"))
        .select("key", "lang", "text")
    )
    fitted = (
        examples.mapInArrow(_vectors, "key long, lang string, seen binary")
        .repartition(1)
        .mapInArrow(_fit(landmarks, ridge), "languages array<string>, landmarks binary, weights binary")
        .first()
    )
    if fitted is None:
        return rows.select(*keep, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("lang_score"))
    model = docs.sparkSession.sparkContext.broadcast((list(fitted[0]), bytes(fitted[1]), bytes(fitted[2])))
    schema = StructType([*rows.schema[:-1], StructField("lang_pred", StringType()), StructField("lang_score", DoubleType())])
    return mapped(rows, _predict(model), schema)

"""Benchmark decontamination by size-partitioned MinHash containment search.

An item leaks into a document when at least ``threshold`` of the item's distinct word shingles
stand in the document. Items are partitioned by size; an item of a partition whose largest size
is ``hi`` is indexed by the ``floor((1 - threshold) * hi) + 1`` smallest of its shingle hashes
(its bottom-k MinHash signature). A document that holds enough of the item cannot miss that many
shingles, so it holds a member of the signature: the search finds every leak, however long the
document, and the exact containment decides on what it finds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import mapped, written
from parcelmart.llm.words import runs, shingle_sets, shingles, word_hashes, word_spans

FILTER_BITS = 22


def _item_sets(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, end, data, offsets in runs(batch.column(1)):
                starts, stops, first_word = word_spans(data, offsets)
                width = np.minimum(np.diff(first_word), shingle)
                (_, _, made, bounds), = shingle_sets(batch.column(1).slice(first, end - first), shingle)
                yield pa.record_batch(
                    [
                        ids.slice(first, end - first),
                        pa.array(width, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(made.view(np.int64))),
                    ],
                    names=["item_id", "width", "shingles"],
                )

    return make


class _Block:
    """The signatures and shingle sets of one block of items, as flat arrays."""

    def __init__(self, rows: list, threshold: float):
        self.ids = [r["item_id"] for r in rows]
        self.widths = np.array([r["width"] for r in rows])
        self.sets = [np.sort(np.array(r["shingles"], np.int64).view(np.uint64)) for r in rows]
        members, owners = [], []
        for k, s in enumerate(self.sets):
            hi = 2 ** ceil(np.log2(len(s) + 1)) - 1  # the largest size of the item's partition
            kept = s[: floor((1 - threshold) * hi + 1e-9) + 1]
            members.append(kept)
            owners.append(np.full(len(kept), k))
        flat, owners = np.concatenate(members), np.concatenate(owners)
        order = np.argsort(flat, kind="stable")
        self.members, self.owners = flat[order], owners[order]
        self.seen = np.zeros(1 << FILTER_BITS, bool)
        self.seen[(flat >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def candidates(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in hashes, item) of every signature member met."""
        at = np.flatnonzero(self.seen[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        low = np.searchsorted(self.members, hashes[at], "left")
        n = np.searchsorted(self.members, hashes[at], "right") - low
        start = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        return np.repeat(at, n), self.owners[start + np.arange(n.sum())]


def _search(block, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = block.value
        for batch in batches:
            found = {"doc": [], "item": [], "size": [], "shared": []}
            for first, _, data, offsets in runs(batch.column(1)):
                starts, stops, first_word = word_spans(data, offsets)
                words = word_hashes(data, starts, stops)
                for width in np.unique(index.widths):
                    made, bounds = shingles(words, first_word, int(width))
                    at, item = index.candidates(made)
                    row = np.searchsorted(bounds, at, "right") - 1
                    pairs = np.unique(np.stack([row, item]), axis=1).T if len(at) else []
                    last, inside = -1, None
                    for r, k in pairs:
                        if index.widths[k] != width:
                            continue
                        if r != last:
                            last, inside = r, np.sort(made[bounds[r] : bounds[r + 1]])
                        own = index.sets[k]
                        near = np.minimum(np.searchsorted(inside, own), len(inside) - 1)
                        shared = int((inside[near] == own).sum())
                        if shared >= threshold * len(own) - 1e-9:
                            found["doc"].append(first + r)
                            found["item"].append(index.ids[k])
                            found["size"].append(len(own))
                            found["shared"].append(shared)
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(found["doc"], pa.int64())),
                    batch.column(2).take(pa.array(found["doc"], pa.int64())),
                    pa.array(found["item"], pa.int64()),
                    pa.array(found["size"], pa.int64()),
                    pa.array(found["shared"], pa.int64()),
                ],
                names=["doc_id", "version", "item_id", "n_shingles", "n_shared"],
            )

    return find


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = 5,
    threshold: float = 0.8,
    block_shingles: int = 2_000_000,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and item it leaks: doc_id, item_id, n_shingles (of the item),
    n_shared, containment.

    Words are runs of non-blank characters with A-Z lower-cased; an item of fewer words than
    ``shingle`` is one shingle of all its words. Items are sent to the tasks in blocks of about
    ``block_shingles`` shingles, with one pass over the documents for each block, so what is
    broadcast does not grow with the benchmark. Null, empty and blank texts leak nothing and
    cannot leak. Rows without an id are searched as well and give a null id. Repeated documents
    and items give one row, with the largest containment where texts under one id differ. Only the
    named columns are read, so others may have any name. Empty tables give no rows.
    """
    return (
        _leaks(docs, items, shingle, threshold, block_shingles, doc_id, text, item_id, item_text)
        .withColumn("containment", F.col("n_shared") / F.col("n_shingles"))
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("containment", "n_shingles", "n_shared")).alias("best"))
        .select("doc_id", "item_id", "best.n_shingles", "best.n_shared", "best.containment")
    )


def _leaks(
    docs: DataFrame,
    items: DataFrame,
    shingle: int = 5,
    threshold: float = 0.8,
    block_shingles: int = 2_000_000,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, version, item_id, n_shingles, n_shared) of every row that leaks an item; ``version`` is
    the hash of its text."""
    spark = docs.sparkSession
    sets = written(
        items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
        .mapInArrow(_item_sets(shingle), "item_id long, width int, shingles array<long>")
        .filter("width > 0"),
        "benchmark-sets",
    )
    total = sets.agg(F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()[0]
    blocks = max(1, ceil(total / block_shingles))
    body = F.col(text).cast("string")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"), F.xxhash64(body).alias("version"))
    found = spark.createDataFrame([], "doc_id long, version long, item_id long, n_shingles long, n_shared long")
    for number in range(blocks):
        own = sets.filter(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == number).collect()
        if own:
            index = spark.sparkContext.broadcast(_Block(own, threshold))
            found = found.union(mapped(texts, _search(index, threshold), found.schema))
    return found


def without_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows whose own text leaks no item, whatever other rows share their id or have none."""
    name, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    leaks = _leaks(docs, items, **options).select(F.col("doc_id").alias("leaked"), F.col("version").alias("leaked_version")).distinct()
    version = F.xxhash64(docs[text].cast("string"))
    same = docs[name].cast("long").eqNullSafe(leaks["leaked"]) & (version == leaks["leaked_version"])
    return docs.join(leaks, same, "left_anti")

"""Similarity join of documents on the Jaccard similarity of their word n-gram sets.

Rows with equal sets form a class and take part once. N-grams are ordered rare first by a table of
frequencies over all documents; two sets that are similar enough share an n-gram within a prefix
of that order, so classes meet on their prefix n-grams only. Of those that meet, pairs are dropped by
the length filter and by the positional filter (too few n-grams left after the shared one). Before
sets are moved, pairs are also dropped by part sizes: the sets are cut into 256 parts by hash, and at
least as many n-grams are not shared as the sizes of the parts differ, summed over the parts; while pairs
are joined, with the parities of the sizes, then with the sizes themselves. Where both sets are at
hand, the suffix filter takes what stands behind the first shared n-gram: the middle n-gram of one rest
cuts both, the parts' sizes bound what is not shared, and the parts are cut again. What is left is
verified once per pair on the whole sets.

N-grams and classes are 64-bit hashes; two that differ are taken as one with a probability of
2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import mapped, written
from parcelmart.llm.graph import components
from parcelmart.llm.words import mix, shingle_sets

CELL_BITS = 20  # n-grams are counted in so many hash cells
BLOCK = 4096  # cells of one row of counts
FILTER_BITS = 23
PARITY = ["p0", "p1", "p2", "p3"]
PARTS = 256
DEPTH = 4  # how often the suffix filter cuts
KEY = "near duplicate key"
SETS = "doc_id long, n int, cls long, p0 long, p1 long, p2 long, p3 long, parts binary, block int, counts binary"


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _classes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each row's set."""
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), out=total[1:])
    return mix((total[bounds[1:]] - total[bounds[:-1]]) ^ np.diff(bounds).astype(np.uint64)).view(np.int64)


def _rare_first(hashes: np.ndarray, bounds: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order by row, rank and hash of n-grams sorted by hash within rows; and each n-gram's row."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return np.argsort(row * 256 + ranks[_cells(hashes)], kind="stable"), row


def _part_sizes(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each row the number of n-grams in each of 256 parts."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    sizes = np.bincount(row * PARTS + (hashes & np.uint64(PARTS - 1)).astype(np.int64), minlength=PARTS * (len(bounds) - 1))
    return sizes.reshape(-1, PARTS)


def _describe(words: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each row its id, set size, class and parities; after them the counts of n-grams by cell."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "cls", *PARITY, "parts", "block", "counts"]
        total = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            for first, end, hashes, bounds in shingle_sets(batch.column(1), words):
                total += np.bincount(_cells(hashes), minlength=1 << CELL_BITS)
                sizes = _part_sizes(hashes, bounds)
                parities = np.packbits((sizes & 1).astype(bool), axis=1).view(np.int64)
                least = np.minimum(sizes, 255).astype(np.uint8)  # a size beyond 255 counts as 255, which keeps the bound
                rows = end - first
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, rows),
                        pa.array(np.diff(bounds), pa.int32()),
                        pa.array(_classes(hashes, bounds)),
                        *(pa.array(np.ascontiguousarray(parities[:, k])) for k in range(4)),
                        pa.array([x.tobytes() for x in least], pa.binary()),
                        pa.nulls(rows, pa.int32()),
                        pa.nulls(rows, pa.binary()),
                    ],
                    names=names,
                )
        blocks = total.reshape(-1, BLOCK)
        used = np.flatnonzero(blocks.any(1))
        empty = [pa.nulls(len(used), t) for t in (pa.int64(), pa.int32(), pa.int64(), *[pa.int64()] * 4, pa.binary())]
        counts = pa.array([blocks[k].astype(np.uint32).tobytes() for k in used], pa.binary())
        yield pa.record_batch([*empty, pa.array(used, pa.int32()), counts], names=names)

    return describe


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums the rows of counts by block as they come, and gives a rank of one byte for each cell."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            total[block] = total.get(block, 0) + np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64)
    ranks = [np.minimum(255, 5 * np.log2(t + 1)).astype(np.uint8).tobytes() for t in total.values()]
    yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array(ranks, pa.binary())], names=["block", "ranks"])


def _ranks(described: DataFrame) -> np.ndarray:
    """The rank of every cell, low for rare n-grams: one byte for each of a fixed number of cells."""
    out = np.zeros(1 << CELL_BITS, np.uint8)
    summed = described.filter("block is not null").select("block", "counts").repartition("block")
    for row in mapped(summed, _add_counts, "block int, ranks binary").collect():
        out[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["ranks"], np.uint8)
    return out


def _prefixes(words: int, percent: int, ranks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(token, cls, n, pos) of the prefix n-grams of each set, a class once per run of rows."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, hashes, bounds in shingle_sets(batch.column(0), words):
                n = np.diff(bounds)
                cls = _classes(hashes, bounds)
                order, row = _rare_first(hashes, bounds, ranks.value)
                pos = np.arange(len(hashes)) - bounds[:-1][row]
                keep = n + (-percent * n) // 100 + 1  # n less the least overlap with a similar set, and one
                once = np.zeros(len(n), bool)
                once[np.unique(cls, return_index=True)[1]] = True
                wanted = (pos < keep[row]) & once[row]
                row = row[wanted]
                yield pa.record_batch(
                    [
                        pa.array(hashes[order][wanted].view(np.int64)),
                        pa.array(cls[row]),
                        pa.array(n[row], pa.int32()),
                        pa.array(pos[wanted], pa.int32()),
                    ],
                    names=["token", "cls", "n", "pos"],
                )

    return prefixes


def _wanted_sets(words: int, wanted, ranks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(cls, grams) of the rows whose class may be wanted, by a table of bits; n-grams are rare first."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy().view(np.uint64)
            marked = bits[(mix(ids) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] | ~np.asarray(batch.column(0).is_valid())
            chosen = batch.filter(pa.array(marked))
            for _, _, hashes, bounds in shingle_sets(chosen.column(1), words):
                order, _ = _rare_first(hashes, bounds, ranks.value)
                grams = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes[order].view(np.int64)))
                yield pa.record_batch([pa.array(_classes(hashes, bounds)), grams], names=["cls", "grams"])

    return sets


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).fill_null(0).to_numpy().view(np.uint64)
        bit = (mix(ids) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
        yield pa.record_batch([pa.array(bit >> 6), pa.array(np.left_shift(np.int64(1), bit & 63))], names=["word", "bits"])


def _sizes_allow(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of pairs (a, b, n_a, n_b, first, parts_a, parts_b) those that the sizes of the parts do not rule out."""

    def allow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, PARTS).astype(np.int64) for k in (5, 6))
            apart = np.abs(a - b).sum(1)
            both = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            yield batch.select([0, 1, 2, 3, 4]).filter(pa.array((100 + percent) * (both - apart) >= 2 * percent * both))

    return allow


def _first_from(keys: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """For each row the first place in ``low`` .. ``high`` of the sorted keys that is not below the wanted one."""
    while (open_ := low < high).any():
        middle = (low + high) // 2
        below = open_ & (keys[np.where(open_, middle, 0)] < wanted)
        low, high = np.where(below, middle + 1, low), np.where(open_ & ~below, middle, high)
    return low


def unshared(
    a: np.ndarray, a_low: np.ndarray, a_high: np.ndarray, b: np.ndarray, b_low: np.ndarray, b_high: np.ndarray, depth: int = DEPTH
) -> np.ndarray:
    """For each row a lower bound on the keys that only one of two sorted runs holds, ``a`` from a_low to
    a_high and ``b`` from b_low to b_high. The middle key of b's run cuts both runs in two."""
    sizes = np.abs((a_high - a_low) - (b_high - b_low))
    cut = np.flatnonzero((a_high > a_low) & (b_high > b_low))
    if not depth or not len(cut):
        return sizes
    a_low, a_high, b_low, b_high = a_low[cut], a_high[cut], b_low[cut], b_high[cut]
    pivot = b[(b_low + b_high) // 2]
    in_a, in_b = _first_from(a, a_low, a_high, pivot), _first_from(b, b_low, b_high, pivot)
    met = (in_a < a_high) & (a[np.where(in_a < a_high, in_a, 0)] == pivot)
    left = unshared(a, a_low, in_a, b, b_low, in_b, depth - 1)
    right = unshared(a, in_a + met, a_high, b, in_b + 1, b_high, depth - 1)
    sizes[cut] = left + right + ~met
    return sizes


def _verify(percent: int, ranks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of pairs (a, b, n_a, n_b, first, grams_a, grams_b), ``first`` being the places of the first shared
    n-gram, those that are similar, with their overlap: the suffix filter, then the whole sets."""

    def runs(grams: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes = grams.flatten().to_numpy().view(np.uint64)
        bounds = np.concatenate([[0], np.cumsum(grams.value_lengths().to_numpy())])
        # keys in the order of the n-grams; two n-grams with one key only weaken the bound
        return hashes, (ranks.value[_cells(hashes)].astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8)), bounds

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b, first = (batch.column(k).to_numpy() for k in (2, 3, 4))
            a, keys_a, bounds_a = runs(batch.column(5))
            b, keys_b, bounds_b = runs(batch.column(6))
            behind_a, behind_b = bounds_a[:-1] + (first >> 32) + 1, bounds_b[:-1] + (first & 0xFFFFFFFF) + 1
            apart = unshared(keys_a, behind_a, bounds_a[1:], keys_b, behind_b, bounds_b[1:])
            rest = bounds_a[1:] - behind_a + bounds_b[1:] - behind_b
            left = np.flatnonzero((100 + percent) * (2 + rest - apart) >= 2 * percent * (n_a + n_b))
            ends = zip(bounds_a[left], bounds_a[left + 1], bounds_b[left], bounds_b[left + 1], strict=True)
            overlap = np.array([len(np.intersect1d(a[i:j], b[k:m], assume_unique=True)) for i, j, k, m in ends], np.int64)
            similar = (100 + percent) * overlap >= percent * (n_a + n_b)[left]
            kept = batch.select([0, 1, 2, 3]).take(pa.array(left[similar]))
            yield pa.record_batch([*kept.columns, pa.array(overlap[similar])], names=["a", "b", "n_a", "n_b", "overlap"])

    return verify


def _similar(percent: int, overlap: Column, n_a: Column, n_b: Column) -> Column:
    """Whether an overlap of that size (or a bound on it) is enough."""
    return (100 + percent) * overlap >= percent * (n_a + n_b)


def _close(percent: int, a: str, b: str) -> Column:
    """Length and positional filter, and that by the parities of part sizes, for rows ``a`` and ``b`` with a shared n-gram."""
    n_a, n_b = F.col(f"{a}.n").cast("long"), F.col(f"{b}.n").cast("long")
    left = F.least(n_a - F.col(f"{a}.pos"), n_b - F.col(f"{b}.pos"))
    apart = sum((F.bit_count(F.col(f"{a}.{p}").bitwiseXOR(F.col(f"{b}.{p}"))) for p in PARITY), F.lit(0))
    length = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    parts = (100 + percent) * (n_a + n_b - apart) >= 2 * percent * (n_a + n_b)  # the overlap is at most half of n_a + n_b - apart
    return length & _similar(percent, left, n_a, n_b) & parts


class _Join:
    """The tables of one join: what each row is, the classes, and the prefix n-grams that classes share."""

    def __init__(self, docs: DataFrame, words: int, percent: int, doc_id: str, text: str):
        if not 0 < percent <= 100:
            raise ValueError("percent must be in 1..100")
        self.words, self.percent, self.spark = words, percent, docs.sparkSession
        self.rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
        described = written(mapped(self.rows, _describe(words), SETS), "ngram-sets")
        self.described = described.filter("block is null").drop("block", "counts")
        self.classes = written(
            self.described.filter("n > 0")
            .groupBy("cls")
            .agg(F.min("doc_id").alias("root"), F.count("*").alias("rows"), *(F.first(p).alias(p) for p in [*PARITY, "parts"])),
            "ngram-classes",
        )
        self.ranks = self.spark.sparkContext.broadcast(_ranks(described))
        postings = written(
            mapped(self.rows.select("text"), _prefixes(words, percent, self.ranks), "token long, cls long, n int, pos int"), "ngram-prefixes"
        )
        often = postings.groupBy("token").count().filter("count > 1").select("token")
        met = written(
            postings.join(often, "token").dropDuplicates(["token", "cls"]).join(self.classes.select("cls", *PARITY), "cls"), "ngram-met"
        )
        # a token's pivot is the class in which it stands first: the one with the fewest rarer n-grams
        pivots = met.groupBy("token").agg(F.min(F.struct("pos", "cls")).alias("pivot"))
        self.shared = met.join(pivots, "token")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs of classes (a, b, n_a, n_b, first) that are similar, with their overlap."""
        parts = lambda side: self.classes.select(F.col("cls").alias(side), F.col("parts").alias(f"parts_{side}"))
        sized = pairs.join(parts("a"), "a").join(parts("b"), "b").select("a", "b", "n_a", "n_b", "first", "parts_a", "parts_b")
        pairs = written(mapped(sized, _sizes_allow(self.percent), "a long, b long, n_a long, n_b long, first long"), "ngram-candidates")
        ends = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
        ends = written(ends.join(self.classes.select("cls", "root"), "cls"), "ngram-ends")
        marks = mapped(ends.select("root").filter("root is not null"), _mark, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        words = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        for row in marks.collect():  # at most 2**17 rows
            words[row["word"]] = row["bits"]
        wanted = self.spark.sparkContext.broadcast(np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool))
        # the rows that roots name; a row that comes twice or is not wanted changes no distinct pair
        sets = written(mapped(self.rows, _wanted_sets(self.words, wanted, self.ranks), "cls long, grams array<long>"), "ngram-verify")
        both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("grams").alias("grams_a")), "a").join(
            sets.select(F.col("cls").alias("b"), F.col("grams").alias("grams_b")), "b"
        )
        both = both.select("a", "b", "n_a", "n_b", "first", "grams_a", "grams_b")
        verified = mapped(both, _verify(self.percent, self.ranks), "a long, b long, n_a long, n_b long, overlap long")
        return written(verified.distinct(), "ngram-links")

    def _pairs(self, left: DataFrame, right: DataFrame, apart: Column) -> DataFrame:
        met = left.alias("x").join(right.alias("y"), (F.col("x.token") == F.col("y.token")) & apart & _close(self.percent, "x", "y"))
        ordered = F.col("x.cls") < F.col("y.cls")
        pick = lambda name, a, b: F.when(ordered, F.col(f"{a}.{name}")).otherwise(F.col(f"{b}.{name}"))
        # a similar pair also meets on the first n-gram it shares, which has the least place in both
        first = F.shiftleft(pick("pos", "x", "y").cast("long"), 32).bitwiseOR(pick("pos", "y", "x").cast("long"))
        return (
            met.select(
                pick("cls", "x", "y").alias("a"),
                pick("cls", "y", "x").alias("b"),
                pick("n", "x", "y").cast("long").alias("n_a"),
                pick("n", "y", "x").cast("long").alias("n_b"),
                first.alias("first"),
            )
            .groupBy("a", "b", "n_a", "n_b")
            .agg(F.min("first").alias("first"))
        )

    def all_links(self) -> DataFrame:
        """Every similar pair of classes."""
        return self.verified(self._pairs(self.shared, self.shared, F.col("x.cls") < F.col("y.cls")))

    def labels(self) -> DataFrame:
        """(cls, label) of the classes that are linked with others, a label for each component.

        First each class is held against the pivots of its n-grams, which links nearly all of a group
        of copies in a number of pairs that grows with the group, not with its square. Then
        classes that share an n-gram but are still in different components are held against each
        other: of each list, those outside the pivot's component against all.
        """
        pivots = self.shared.select("token", "cls", "n", "pos", *PARITY).alias("x")
        at_pivot = self.shared.filter("cls = pivot.cls").alias("y")
        first = self.verified(self._pairs(pivots, at_pivot, F.col("x.cls") != F.col("y.cls")))
        found = written(components(first), "ngram-components")
        # classes without a link are their own component
        own = self.shared.join(found.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        own = written(own, "ngram-grouped")
        centre = own.filter("cls = pivot.cls").select("token", F.col("component").alias("centre"))
        outside = own.join(centre, "token").filter("component <> centre").drop("centre")
        second = self._pairs(
            outside,
            own,
            (F.col("x.component") != F.col("y.component")) & (F.col("y.cls") != F.col("x.pivot.cls")),
        )
        links = self.verified(second)
        name = lambda side: found.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
        merged = (
            links.join(name("a"), "a", "left")
            .join(name("b"), "b", "left")
            .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
        )
        joined = written(components(merged), "ngram-merged")
        every = found.unionByName(joined.select("node", F.col("node").alias("component"))).distinct()
        after = joined.select(F.col("node").alias("component"), F.col("component").alias("label"))
        return (
            every.join(after, "component", "left")
            .groupBy(F.col("node").alias("cls"))
            .agg(F.min(F.coalesce("label", "component")).alias("label"))
        )


def similar_pairs(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(pairs, members): every pair (a, b) of different n-gram sets with a Jaccard similarity of
    ``percent`` or more, as the smallest ids that have them, with n_a, n_b and overlap; and for each
    row its doc_id, n_ngrams and the smallest id with the same set. All pairs are listed, so the
    output of a large group of near copies is large; ``near_duplicates`` is not."""
    join = _Join(docs, words, percent, doc_id, text)
    root = lambda side: join.classes.select(F.col("cls").alias(side), F.col("root").alias(f"root_{side}"))
    pairs = (
        join.all_links()
        .join(root("a"), "a")
        .join(root("b"), "b")
        .select(F.col("root_a").alias("a"), F.col("root_b").alias("b"), "n_a", "n_b", "overlap")
    )
    members = join.described.join(join.classes.select("cls", "root"), "cls", "left").select("doc_id", F.col("n").cast("long").alias("n_ngrams"), F.col("root").alias("class_id"))
    return pairs, members


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_ngrams (the size of its set of ``words``-word n-grams) and
    component_id, the smallest doc_id that links reach from it, its own included.

    Two rows link when the Jaccard similarity of their sets is ``percent`` or more, so repeated rows
    and equal texts always do. A text with fewer words is one n-gram; null, empty and blank texts
    have none and link with nothing. Rows without an id are linked like others, but a null id is never
    the smallest. Only the named columns are read; an empty table gives no rows.
    """
    join = _Join(docs, words, percent, doc_id, text)
    named = join.classes.join(join.labels(), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    roots = named.groupBy("label").agg(F.min("root").alias("component_id"), F.sum("rows").alias("rows")).filter("rows > 1")
    linked = named.join(roots.select("label", "component_id"), "label").select("cls", "component_id")
    return join.described.join(linked.withColumn("any", F.lit(1)), ["cls"], "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_ngrams"),
        F.when((F.col("n") > 0) & F.col("any").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row with the smallest id
    (null last) and then the smallest hash of its text, once. Rows without an n-gram all stay."""
    body = F.col(text).cast("string")
    key = F.xxhash64(F.col(doc_id).cast("long"), body)
    found = written(
        near_duplicates(docs.select(key.alias("key"), body.alias("text")), words, percent, "key", "text").filter("n_ngrams > 0").select(
            F.col("doc_id").alias("key"), "component_id"
        ),
        "ngram-found",
    )
    ids = docs.select(key.alias("key"), F.col(doc_id).cast("long").alias("id"))
    grouped = found.groupBy("key", "component_id").agg(F.count("*").alias("rows"))
    many = grouped.groupBy("component_id").agg(F.sum("rows").alias("n")).filter("n > 1")
    members = grouped.join(many.select("component_id"), "component_id")
    named = members.join(ids.distinct(), "key")
    best = named.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("best"))
    best = written(best.select(F.col("best.key").alias("best")), "ngram-best")
    gone = written(members.select("key").distinct().withColumnRenamed("key", "gone"), "ngram-gone")
    kept = docs.join(gone, key == gone["gone"], "left_anti")
    chosen = docs.join(best, key == best["best"], "left_semi")
    once = chosen.withColumn(KEY, key).dropDuplicates([KEY]).drop(KEY)
    return kept.unionByName(once)

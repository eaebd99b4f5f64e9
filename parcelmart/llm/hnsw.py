"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard.

Equal vectors form a class and are indexed once, since copies of one vector would fill each other's
neighbour lists and cut the graph off. Classes are dealt to shards of bounded size by hash. A shard's
graph is kept as flat arrays: its vectors, the level of each node, and the neighbour lists of all
levels one after the other. Each shard's graph is loaded once for a block of queries, which pass by it as a
stream; blocks are so large that queries, not graphs, are what is sent. The shards' answers are
merged by distance.

Inserting and searching work on many points at a time: all beams of a batch take one step together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmart.llm.common import mapped, written

INDEX = "dim int, shard int, size int, vectors binary, members array<array<long>>, levels binary, links binary"
FOUND = "rep long, members array<long>, score double"


def _pick(distances: np.ndarray, between: Callable[[np.ndarray], np.ndarray], degree: int) -> np.ndarray:
    """For each row the columns to link, at most ``degree``: in order of distance, those that are
    nearer to the point than to every neighbour picked before; then the nearest of the others.
    Missing candidates have an infinite distance. Returns columns, -1 where there are fewer."""
    rows, width = distances.shape
    order = np.argsort(distances, axis=1, kind="stable")
    ordered = np.take_along_axis(distances, order, 1)
    apart = between(order)
    chosen = np.zeros((rows, width), bool)
    for j in range(width):
        blocked = (chosen[:, :j] & (apart[:, j, :j] < ordered[:, j, None])).any(1)
        chosen[:, j] = ~blocked & np.isfinite(ordered[:, j]) & (chosen[:, :j].sum(1) < degree)
    rank = np.where(chosen, 0, 1) * width + np.arange(width)
    rank[~np.isfinite(ordered)] = 3 * width
    first = np.argsort(rank, axis=1, kind="stable")[:, :degree]
    picked = np.take_along_axis(order, first, 1)
    return np.where(np.isfinite(np.take_along_axis(distances, picked, 1)), picked, -1)


def _without_repeats(nodes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Rows of nodes with -1 for repeats within a row and for the row's own node."""
    order = np.argsort(nodes, axis=1, kind="stable")
    ordered = np.take_along_axis(nodes, order, 1)
    again = np.zeros(nodes.shape, bool)
    again[:, 1:] = ordered[:, 1:] == ordered[:, :-1]
    repeated = np.empty_like(again)
    np.put_along_axis(repeated, order, again, 1)
    return np.where(repeated | (nodes == own[:, None]), -1, nodes)


class Graph:
    """A graph over the rows of ``vectors``."""

    def __init__(self, vectors: np.ndarray, degree: int = 12, beam: int = 64):
        self.original = vectors
        size = np.abs(vectors).max(1, initial=0)
        self.scale = float(np.median(size)) if len(size) and np.median(size) > 0 else 1.0
        # single precision unless the square of some component would leave its range
        alike = not len(size) or (size.max() < 1e15 * self.scale and size.min() > 1e-15 * self.scale)
        self.type = np.float32 if alike else np.float64
        self.x = self._scaled(vectors)
        self.squares = np.einsum("nd,nd->n", self.x, self.x)
        self.degree, self.beam = degree, beam
        self.levels = np.zeros(len(vectors), np.int8)
        self.links: list[np.ndarray] = []

    def _scaled(self, vectors: np.ndarray) -> np.ndarray:
        far = 1e15 if self.type == np.float32 else 1e150
        with np.errstate(over="ignore"):
            return np.clip(vectors / self.scale, -far, far).astype(self.type)

    def _width(self, level: int) -> int:
        return 2 * self.degree if level == 0 else self.degree

    def _distances(self, points: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of each point to its row of nodes; infinite for node -1."""
        dots = np.einsum("qd,qmd->qm", points, self.x[nodes])
        out = self.squares[nodes] - 2 * dots + np.einsum("qd,qd->q", points, points)[:, None]
        return np.where(nodes >= 0, out, np.inf).astype(self.type)

    def _between(self, nodes: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        def between(order: np.ndarray) -> np.ndarray:
            own = np.take_along_axis(nodes, order, 1)
            v = self.x[own]
            dots = np.matmul(v, v.transpose(0, 2, 1))
            s = self.squares[own]
            return s[:, :, None] + s[:, None, :] - 2 * dots

        return between

    def _walk(self, points: np.ndarray, entries: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest nodes found (at most ``beam``; -1 where fewer) and their squared distances.
        Ends when every node in a beam has been left."""
        q, links = len(points), self.links[level]
        seen = np.zeros((q, len(self.x)), bool)
        nodes = np.full((q, beam), -1, np.int32)
        near = np.full((q, beam), np.inf, self.type)
        left = np.zeros((q, beam), bool)
        starts = entries[:, :beam]
        nodes[:, : starts.shape[1]] = starts
        near[:, : starts.shape[1]] = self._distances(points, starts)
        seen[np.arange(q)[:, None], np.maximum(starts, 0)] |= starts >= 0
        live = np.arange(q)
        while True:
            open_ = np.where(left[live], np.inf, near[live])
            at = open_.argmin(1)
            good = np.isfinite(open_[np.arange(len(live)), at])
            live, at = live[good], at[good]
            if not len(live):
                return nodes, near
            left[live, at] = True
            new = links[nodes[live, at]]
            fresh = (new >= 0) & ~seen[live[:, None], new]
            new = np.where(fresh, new, -1)
            where, what = np.nonzero(fresh)
            seen[live[where], new[where, what]] = True
            d = self._distances(points[live], new)
            all_near = np.concatenate([near[live], d], 1)
            best = np.argpartition(all_near, beam - 1, axis=1)[:, :beam]
            near[live] = np.take_along_axis(all_near, best, 1)
            nodes[live] = np.take_along_axis(np.concatenate([nodes[live], new], 1), best, 1)
            left[live] = np.take_along_axis(np.concatenate([left[live], np.zeros_like(fresh)], 1), best, 1)

    def _entries(self, points: np.ndarray, down_to: int) -> np.ndarray:
        """One entry node for each point at level ``down_to``, by greedy steps from the top."""
        nodes = np.full((len(points), 1), self.entry, np.int32)
        for level in range(len(self.links) - 1, down_to, -1):
            nodes = self._walk(points, nodes, level, 1)[0]
        return nodes

    def _link(self, level: int, ids: np.ndarray, candidates: np.ndarray) -> None:
        """Links each id with the best of its row of candidates, and these back with it."""
        links, width = self.links[level], self._width(level)
        candidates = _without_repeats(candidates, ids)
        d = self._distances(self.x[ids], candidates)
        picked = _pick(d, self._between(candidates), width)
        rows = np.where(picked >= 0, np.take_along_axis(candidates, picked, 1), -1)
        links[ids] = rows
        a, b = np.nonzero(rows >= 0)
        to, back = rows[a, b], ids[a]
        # the nearest of the new back links, as many as a list holds
        far = np.take_along_axis(d, picked, 1)[a, b]
        order = np.lexsort((far, to))
        to, back = to[order], back[order]
        begin = np.concatenate([[True], to[1:] != to[:-1]])
        rank = np.arange(len(to)) - np.maximum.accumulate(np.where(begin, np.arange(len(to)), 0))
        to, back, rank = to[rank < width], back[rank < width], rank[rank < width]
        touched, row = np.unique(to, return_inverse=True)
        new = np.full((len(touched), width), -1, np.int32)
        new[row, rank] = back
        both = _without_repeats(np.concatenate([links[touched], new], 1), touched)
        for first in range(0, len(touched), 1024):
            part, own = both[first : first + 1024], touched[first : first + 1024]
            kept = _pick(self._distances(self.x[own], part), self._between(part), width)
            links[own] = np.where(kept >= 0, np.take_along_axis(part, kept, 1), -1)

    def build(self, seed: int = 5) -> Graph:
        n = len(self.x)
        random = np.random.default_rng(seed)
        draws = -np.log(1 - random.random(n)) / np.log(self.degree)
        self.levels = np.minimum(draws, 12).astype(np.int8)
        self.entry = int(self.levels.argmax()) if n else -1
        for level in range(int(self.levels.max(initial=0)) + 1):
            self.links.append(np.full((n, self._width(level)), -1, np.int32))
        # the node of the highest level goes first; the others in the given order
        order = np.concatenate([[self.entry], np.delete(np.arange(n), self.entry)]) if n else np.arange(0)
        done = 0
        while done < n:
            batch = order[done : done + min(512, max(1, done))]
            points = self.x[batch]
            dots = points @ points.T
            mutual = self.squares[batch][:, None] + self.squares[batch][None, :] - 2 * dots
            np.fill_diagonal(mutual, np.inf)
            candidates = []
            for level in range(int(self.levels[batch].max()) + 1):
                here = np.flatnonzero(self.levels[batch] >= level)
                beside = mutual[np.ix_(here, here)]
                close = np.argsort(beside, axis=1, kind="stable")[:, : self._width(level)]
                own = np.where(np.isfinite(np.take_along_axis(beside, close, 1)), batch[here][close], -1)
                if done:  # only what was there before the batch is walked
                    found = self._walk(points[here], self._entries(points[here], level), level, self.beam)[0]
                    own = np.concatenate([found, own], 1)
                candidates.append((level, batch[here], own))
            for level, ids, own in candidates:
                if (own >= 0).any():
                    self._link(level, ids, own.astype(np.int32))
            done += len(batch)
        return self

    def search(self, points: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each point the ``k`` nearest nodes found and their Euclidean distances in double
        precision, nearest first; -1 and infinite where there are fewer."""
        nodes = np.full((len(points), k), -1, np.int64)
        scores = np.full((len(points), k), np.inf)
        for first in range(0, len(points), 512):
            part = points[first : first + 512]
            scaled = self._scaled(part)
            found, _ = self._walk(scaled, self._entries(scaled, 0), 0, max(beam, k))
            exact = np.sqrt(((self.original[found] - part[:, None, :]) ** 2).sum(2))
            exact = np.where(found >= 0, exact, np.inf)
            best = np.argsort(exact, axis=1, kind="stable")[:, :k]
            scores[first : first + 512, : best.shape[1]] = np.take_along_axis(exact, best, 1)
            nodes[first : first + 512, : best.shape[1]] = np.take_along_axis(found, best, 1)
        return nodes, scores

    def flat(self) -> tuple[bytes, bytes]:
        """(levels, neighbour lists of the nodes of each level, level by level)."""
        lists = [links[self.levels >= level].ravel() for level, links in enumerate(self.links)]
        return self.levels.tobytes(), np.concatenate(lists).tobytes() if lists else b""

    @classmethod
    def from_flat(cls, vectors: np.ndarray, levels: bytes, links: bytes, degree: int) -> Graph:
        out = cls(vectors, degree)
        out.levels = np.frombuffer(levels, np.int8)
        out.entry = int(out.levels.argmax())
        flat, at = np.frombuffer(links, np.int32), 0
        for level in range(int(out.levels.max()) + 1):
            own = np.flatnonzero(out.levels >= level)
            width = out._width(level)
            table = np.full((len(vectors), width), -1, np.int32)
            table[own] = flat[at : at + len(own) * width].reshape(-1, width)
            at += len(own) * width
            out.links.append(table)
        return out


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _build(degree: int, beam: int) -> Callable[[pa.Table], pa.Table]:
    def build(rows: pa.Table) -> pa.Table:
        dim = rows["dim"][0].as_py()
        rows = rows.sort_by("rep")
        vectors = _matrix(rows["vector"], dim)
        levels, links = Graph(vectors, degree, beam).build().flat()
        return pa.table(
            {
                "dim": pa.array([dim], pa.int32()),
                "shard": pa.array([rows["shard"][0].as_py()], pa.int32()),
                "size": pa.array([len(rows)], pa.int32()),
                "vectors": pa.array([vectors.tobytes()], pa.binary()),
                "members": pa.array([rows["members"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
                "levels": pa.array([levels], pa.binary()),
                "links": pa.array([links], pa.binary()),
            }
        )

    return build


def _search(degree: int, beam: int, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(rep, members, score) of the nearest classes found for queries (dim, shard, block, rep, vector), which come
    sorted by their first three columns, each block behind a row without rep that holds the shard's graph.
    A graph is loaded once for its block, and queries are taken a batch at a time."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, graph, own = None, None, []
        for batch in batches:
            places = np.stack([batch.column(c).to_numpy() for c in range(3)], 1)
            is_graph = np.asarray(batch["rep"].is_null())
            cut = np.ones(len(places), bool)
            cut[1:] = (places[1:] != places[:-1]).any(1) | is_graph[1:] | is_graph[:-1]
            starts = np.flatnonzero(cut).tolist()
            for first, end in zip(starts, [*starts[1:], len(places)], strict=True):
                here, dim = tuple(places[first].tolist()), int(places[first, 0])
                if is_graph[first]:
                    vectors = np.frombuffer(batch["vectors"][first].as_py(), np.float64).reshape(-1, dim)
                    graph = Graph.from_flat(vectors, batch["levels"][first].as_py(), batch["links"][first].as_py(), degree)
                    place, own = here, batch["members"][first].as_py()
                elif here == place:  # a shard that no vector of this length fell into has no graph
                    rows = batch.slice(first, end - first)
                    nodes, near = graph.search(_matrix(rows["vector"], dim), k, beam)
                    found = nodes >= 0
                    reps = np.repeat(rows["rep"].to_numpy(), found.sum(1))
                    members = pa.array([own[node] for node in nodes[found].tolist()], pa.list_(pa.int64()))
                    yield pa.record_batch([pa.array(reps), members, pa.array(near[found])], names=["rep", "members", "score"])

    return search


def _usable(vector: Column) -> Column:
    """Has components, all of them finite numbers and not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    shard_rows: int = 16384,
    block_rows: int = 65536,
    degree: int = 12,
    build_beam: int = 64,
    search_beam: int = 256,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest rows found for every row for which ``is_query`` (a condition on vec_id) holds:
    query_id, rank (from 1), vec_id, score (Euclidean distance in double precision).

    Every usable row is indexed and is a candidate for all queries but itself; ties go to the smaller
    vec_id. Vectors that are null, empty, all zero or hold null or non-finite components, and rows
    without an id, take no part. A repeated id counts once, with its smallest vector. Vectors
    are compared with those of the same length only. With fewer candidates than ``k`` all of a
    shard that are reached come back; an empty table gives no rows. Other columns are ignored.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & _usable(F.col("vector"))).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    rows = written(rows, "vectors")
    # the k + 1 smallest ids of a class are all that can be among the nearest of any query
    by_id = Window.partitionBy("vector").orderBy("vec_id")
    classes = written(
        rows.withColumn("place", F.row_number().over(by_id))
        .filter(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("members")),
        "vector-classes",
    )
    queries = rows.filter(is_query).join(classes.select("vector", "rep"), "vector").select(F.col("vec_id").alias("query_id"), "rep", "vector")
    queries = written(queries, "vector-queries")
    shards = max(1, ceil(classes.count() / shard_rows))
    index = written(
        classes.withColumn("dim", F.size("vector"))
        .withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int"))
        .groupBy("dim", "shard")
        .applyInArrow(_build(degree, build_beam), INDEX),
        "vector-index",
    )
    asked = queries.select("rep", "vector").dropDuplicates(["rep"]).withColumn("dim", F.size("vector"))
    blocks = max(1, ceil(asked.count() / block_rows))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    keys = ["dim", "shard", "block"]
    both = spread.select(*keys, "vectors", "members", "levels", "links").unionByName(asked, allowMissingColumns=True)
    stream = both.repartition(*keys).sortWithinPartitions(*keys, F.col("rep").isNotNull())
    stream = stream.select(*keys, "rep", "vector", "vectors", "members", "levels", "links")
    found = mapped(stream, _search(degree, search_beam, k + 1), FOUND)
    nearest_first = Window.partitionBy("rep").orderBy("score", "vec_id")
    merged = (
        found.select("rep", "score", F.explode("members").alias("vec_id"))
        .withColumn("place", F.row_number().over(nearest_first))
        .filter(F.col("place") <= k + 1)
    )
    own = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        queries.select("query_id", "rep")
        .join(merged, "rep")
        .filter("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(own))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

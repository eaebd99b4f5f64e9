"""Centroid clustering by scalar lookup tables.

Vectors are made integers, so each component has few values. In every round a task tabulates, for each
dimension, each integer that occurs there and each centroid, the squared difference; the distances of
a batch are sums of entries gathered from these tables, in exact integers. Tasks hand over the sums of
their vectors by cluster, a row per cluster and dimension, which Spark adds up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import mapped, written

#: Integers are held within this distance of 0, so that a squared distance of many components is a long.
LARGEST = 1 << 27
#: Values per dimension that a table keeps from batch to batch. If more occur, the table of a batch holds
#: the values of that batch.
KEPT_VALUES = 4096

SUMS = "cluster int, dim int, total long, n long"


class LookupTables:
    """Squared differences of integers and centroid components, filled with the integers that occur."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids.astype(np.int64)
        k, dims = self.centroids.shape
        self.values = [np.empty(0, np.int64) for _ in range(dims)]
        self.squares = [np.empty((0, k), np.int64) for _ in range(dims)]

    def _rows_of(self, dim: int, column: np.ndarray) -> np.ndarray:
        """Where the values of a column stand in the table of a dimension; new values are put in."""
        values = self.values[dim]
        at = np.searchsorted(values, column)
        if len(values) and (values[np.minimum(at, len(values) - 1)] == column).all():
            return at
        occurring = np.unique(column)
        both = np.union1d(values, occurring)
        values = self.values[dim] = both if len(both) <= KEPT_VALUES else occurring
        self.squares[dim] = (values[:, None] - self.centroids[None, :, dim]) ** 2
        return np.searchsorted(values, column)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the nearest centroid of each row (of equally near ones the first), and its squared
        distance."""
        distances = np.zeros((len(vectors), len(self.centroids)), np.int64)
        for dim, column in enumerate(np.ascontiguousarray(vectors.T)):
            rows = self._rows_of(dim, column)
            distances += self.squares[dim][rows]
        cluster = distances.argmin(1)
        return cluster, distances[np.arange(len(vectors)), cluster]


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


Batches = Iterator[pa.RecordBatch]


def _sums(centroids: np.ndarray) -> Callable[[Batches], Batches]:
    """Component sums and numbers of the vectors nearest to each centroid, once per task."""

    def run(batches: Batches) -> Batches:
        k, dims = centroids.shape
        tables, totals, counts = LookupTables(centroids), np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            vectors = _vectors(batch, dims)
            cluster, _ = tables.nearest(vectors)
            for c in np.unique(cluster):
                totals[c] += vectors[cluster == c].sum(0)
            counts += np.bincount(cluster, minlength=k)
        yield pa.record_batch(
            {
                "cluster": pa.array(np.repeat(np.arange(k, dtype=np.int32), dims)),
                "dim": pa.array(np.tile(np.arange(dims, dtype=np.int32), k)),
                "total": pa.array(totals.ravel()),
                "n": pa.array(np.repeat(counts, dims)),
            }
        )

    return run


def _assigned(centroids: np.ndarray) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        tables = LookupTables(centroids)
        for batch in batches:
            cluster, distance = tables.nearest(_vectors(batch, centroids.shape[1]))
            yield pa.record_batch(
                {"vec_id": batch.column("vec_id"), "cluster": pa.array(cluster.astype(np.int32)), "distance": pa.array(distance)}
            )

    return run


def _moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floor of the mean of its vectors; one without vectors stays. Only a row per
    centroid and dimension comes to the driver."""
    sums = mapped(rows.select("vector"), _sums(centroids), SUMS)
    added = sums.groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for row in added.filter("n > 0").collect():
        moved[row.cluster, row.dim] = int(row.total) // row.n
    return moved


def integer_vectors(vectors: DataFrame, dims: int, scale: int, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vector: array of int) of the vectors of ``dims`` finite components; component x becomes
    floor(scale * x), held within +-2**27."""
    x = F.col(embedding).cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))

    def whole(v: Column) -> Column:
        return F.greatest(F.least(F.floor(v * F.lit(float(scale))), F.lit(LARGEST)), F.lit(-LARGEST)).cast("int")

    return vectors.filter((F.size(x) == dims) & ~F.coalesce(odd, F.lit(True))).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, whole).alias("vector")
    )


@dataclass(frozen=True)
class Clusters:
    """Rows (vec_id, cluster, distance: squared) and the centroids by number."""

    rows: DataFrame
    centroids: list[list[int]]


def cluster_vectors(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    seed: int = 1,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> Clusters:
    """Clusters of the integer vectors: ``rounds`` times every vector goes to its nearest centroid (squared
    Euclidean distance, ties to the smaller number) and each centroid to the floor of its vectors' mean;
    then vectors are assigned once more. Centroids start as the ``k`` vectors with the smallest SHA-256 of
    ``<seed>:<vec_id>``.

    Takes part: every row whose vector has exactly ``dims`` components, none null or not finite. Other
    rows, null vectors too, are left out. Repeated rows and ids are rows of their own; rows of one id
    start as centroids in the order of their vectors, rows without an id only after all others. With
    fewer than ``k`` vectors there are as many centroids as vectors; an empty table gives no rows. Components
    beyond +-2**27 after scaling are taken as that. Other columns are ignored. Every round reads the
    written vectors once and shuffles a row per task, cluster and dimension."""
    rows = written(integer_vectors(vectors, dims, scale, vec_id, embedding), "integer-vectors")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(digest.asc_nulls_last(), "vector").limit(k).collect()
    schema = "vec_id long, cluster int, distance long"
    if not first:
        return Clusters(rows.sparkSession.createDataFrame([], schema), [])
    centroids = np.array([row.vector for row in first], np.int64)
    for _ in range(rounds):
        centroids = _moved(rows, centroids)
    return Clusters(written(mapped(rows, _assigned(centroids), schema), "clusters"), centroids.tolist())


def inertias(clusters: Clusters) -> DataFrame:
    """(cluster, cluster_inertia, inertia, centroid): distances added up per cluster that has vectors and
    over all, beside the centroid's components. Sums beyond a long are taken as the largest one."""
    spark, most = clusters.rows.sparkSession, (1 << 63) - 1
    sums = clusters.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    whole = sum(int(r.inertia) for r in sums)
    named = [(r.cluster, min(int(r.inertia), most), min(whole, most), clusters.centroids[r.cluster]) for r in sums]
    return spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid array<int>")

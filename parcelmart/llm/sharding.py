"""Sharding: groups of equal texts dealt to the least loaded shard, largest group first.

Longest-processing-time scheduling places groups one after another, by falling size, each on the shard
that is least loaded then; a heap holds the shards. Groups of one size are alike for it, so what is
placed in turn is one row per *distinct size* of a group with the number of its groups. Distinct sizes
add up to no more than the bytes of the corpus, so there are at most sqrt(2 * bytes) of them, 14
million at 100 TB, and they pass through the heap as a stream. Within one size the shards that have
caught up with each other take turns, so the places of all its groups are a handful of rounds, however
many groups there are. Which of the groups of a size takes which place is decided by their rank, which
Spark counts in parts. The outcome is that of the heap over single groups.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelmart.llm.common import written
from parcelmart.operators.positions import numbered
from parcelmart.session import scratch_path

#: (rank of the first group, the shards of it and the next ones in turn)
Round = tuple[int, list[int]]

ROUNDS = T.StructType(
    [
        T.StructField("bytes", T.LongType()),
        T.StructField(
            "rounds",
            T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("shards", T.ArrayType(T.IntegerType()))])),
        ),
    ]
)
SIZES_AT_ONCE = 100_000  # distinct sizes that the driver holds placed before it writes them


def _rounds_before(load: int, shard: int, size: int, other: tuple[int, int]) -> int:
    """How many groups of ``size`` a shard takes before its load is above that of the ``other`` one."""
    room = other[0] - load
    return max(0, room // size + 1 if shard < other[1] else -(-room // size))


def place(heap: list[tuple[int, int]], size: int, count: int) -> list[Round]:
    """Puts ``count`` groups of one size on the shards of the heap of (load, shard), each on the least
    loaded one (of equal ones the smaller number). Gives the shards by rank of the group: from ``first``
    on, groups go to ``shards`` in turn, again and again, until the next round's first."""
    rounds: list[Round] = []
    turn: deque[tuple[int, int]] = deque()  # shards with a group of this size, the least loaded one first
    placed, single = 0, False
    while placed < count:
        if heap and (not turn or heap[0] < turn[0]):
            load, shard = heappop(heap)
            if not single:
                rounds.append((placed, []))
            rounds[-1][1].append(shard)
            turn.append((load + size, shard))
            placed, single = placed + 1, True
        else:
            n = count - placed
            if heap:
                n = min(n, sum(_rounds_before(load, shard, size, heap[0]) for load, shard in turn))
            rounds.append((placed, [shard for _, shard in turn]))
            each, rest = divmod(n, len(turn))
            turn = deque((load + size * (each + (k < rest)), shard) for k, (load, shard) in enumerate(turn))
            turn.rotate(-rest)
            placed, single = placed + n, False
    for item in turn:
        heappush(heap, item)
    return rounds


def _placed(sizes: Iterator, shards: int) -> Iterator[tuple[int, list[Round]]]:
    heap = [(0, shard) for shard in range(shards)]
    heapify(heap)
    for row in sizes:
        yield row["bytes"], place(heap, row["bytes"], row["n"])


def _write_rounds(spark: SparkSession, sizes: DataFrame, shards: int) -> DataFrame:
    """The rounds of every size. Sizes reach the driver in falling order, a partition at a time, and
    leave it in chunks."""
    path = scratch_path(spark, "rounds")
    placed = _placed(sizes.orderBy(F.desc("bytes")).toLocalIterator(), shards)
    spark.createDataFrame([], ROUNDS).write.parquet(path)
    while chunk := list(islice(placed, SIZES_AT_ONCE)):
        spark.createDataFrame(chunk, ROUNDS).write.mode("append").parquet(path)
    return spark.read.schema(ROUNDS).parquet(path)


def _shard_of(rank: Column) -> Column:
    last = F.element_at(F.filter("rounds", lambda r: r["first"] <= rank), -1)
    return F.get(last["shards"], ((rank - last["first"]) % F.size(last["shards"])).cast("int"))


def group_shards(groups: DataFrame, shards: int) -> DataFrame:
    """(key, shard) of groups (key: binary digest, bytes: long, 1 or more). Of groups of one size the
    one with the smaller key is placed first.

    The rank of a group among those of its size is counted in parts by the first byte of its key, as
    one size may hold a third of all groups; the numbers of the parts are added up on rows of
    (size, part)."""
    part = F.substring("key", 1, 1)
    counts = written(groups.groupBy("bytes", part.alias("part")).agg(F.count("*").alias("n")), "group-counts")
    rounds = _write_rounds(groups.sparkSession, counts.groupBy("bytes").agg(F.sum("n").alias("n")), shards)
    earlier = Window.partitionBy("bytes").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("bytes", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("bytes", "part").orderBy("key")
    ranked = groups.withColumn("part", part).withColumn("row", F.row_number().over(within).cast("long") - 1)
    placed = ranked.join(before.join(rounds, "bytes"), ["bytes", "part"])
    return placed.select("key", _shard_of(F.col("before") + F.col("row")).alias("shard"))


def assign_shards(docs: DataFrame, shards: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of ``docs`` (doc_id: long, text: string).

    Rows of equal texts are a group and stay in one shard; the groups' bytes are dealt by
    longest-processing-time scheduling. A row's size is the UTF-8 bytes of its text plus 1, so rows
    without any bytes are spread as well. ``slot`` numbers the rows of a shard from 0 without gaps, in
    the order of doc_id (no id first; rows of one id in an order of their own).

    Nulls: a null text is the empty text (size 1, crc32 0, one group with it); rows with a null or a
    repeated doc_id are rows of their own. Repeated rows: all kept, in one shard. Ties: groups of equal
    bytes go by their SHA-256, shards of equal loads by their number. Very long texts: hashed whole, never
    shuffled. Empty table: no rows. Other columns are not read. Two texts count as equal if their
    SHA-256 is.

    Texts are read once, for narrow rows; a group is summed before the shuffle, and the join that takes
    groups to rows is one that Spark splits where a group is hot."""
    if shards < 1:
        raise ValueError("there must be a shard")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("key"),
        F.monotonically_increasing_id().alias("row"),  # tells rows apart once they are written
    )
    rows = written(rows, "shard-rows")
    groups = written(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "shard-groups")
    placed = written(rows.join(group_shards(groups, shards), "key").drop("key"), "sharded")
    order = [F.col("doc_id"), F.col("row")]
    return numbered(placed, ["shard"], order, "slot").select("doc_id", "size", "text_crc32", "shard", "slot")


def shard_loads(assigned: DataFrame) -> DataFrame:
    """(shard, n_rows, bytes) of ``assign_shards``, one row per shard that has any."""
    return assigned.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("bytes"))

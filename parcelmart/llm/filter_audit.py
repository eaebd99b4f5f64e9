"""Filter interaction audit: what each filter of a chain removes, in every order of the filters.

One table per filter holds the ids of the rows that fail it. What survives a prefix of an order is the
table of all ids left-anti joined with the id tables of the prefix; what the next filter removes is what
survives, left-semi joined with the filter's ids. Both depend on the set of the filters in the prefix
alone, so the sets are worked through by size: one table holds the survivors of all sets of a size, and
gives the removals of each further filter and the survivors of the next size. All tables are bucketed
by id, so none of the joins shuffles a row.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import release, written
from parcelmart.operators.buckets import Bucketed, write_buckets

SPACES = r"[\x20\x09-\x0D]+"
ALL = "all"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _survivors(universe: Bucketed, failing: list[Bucketed], buckets: int) -> tuple[DataFrame, DataFrame]:
    """Counts by set of filters (as bits): (prefix, part, kind, n) of the rows that survive it, and
    (prefix, filter, part, kind, n) of those that the filter removes after it. Drops ``universe``. Each size
    begins by giving back what the driver planned and broadcast for the one before."""
    kept, removed, level = [], [], universe
    for size in range(len(failing) + 1):
        release(universe.spark)
        rows = level.rows
        kept.append(written(rows.groupBy("prefix", "part", "kind").agg(F.count("*").alias("n")), "audit-kept"))
        if size == len(failing):
            break
        losses, further = [], []
        for k, ids in enumerate(failing):
            bit = 1 << k
            open_sets = rows.filter(F.col("prefix").bitwiseAND(bit) == 0)
            losses.append(open_sets.join(ids.rows, "id", "left_semi").withColumn("filter", F.lit(k)))
            if bit >> size:  # a larger set is reached by its last filter, so from one set only
                lower_sets = rows.filter(F.col("prefix") < bit)
                further.append(lower_sets.join(ids.rows, "id", "left_anti").withColumn("prefix", F.col("prefix").bitwiseOR(bit)))
        lost = _union(losses).groupBy("prefix", "filter", "part", "kind").agg(F.count("*").alias("n"))
        removed.append(written(lost, "audit-removed"))
        release(universe.spark)
        below, level = level, write_buckets(_union(further), "id", buckets, "audit_level", shuffle=False)
        below.drop()
    level.drop()
    return _union(kept), _union(removed)


def _number(n: Column) -> Column:
    return F.coalesce(n, F.lit(0)).cast("long")


def audit(rows: DataFrame, failing: dict[str, DataFrame], kinds: dict[str, DataFrame]) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, <kind>_lost ..., shapley), one row
    per part, order of the filters and step, zeros included.

    ``rows``: (id: long, unique; part: string). ``failing``: per filter, by a name of one letter, the
    (id, part) of the rows that fail it. ``kinds``: per name the (id, part) of rows whose loss is counted
    apart. Counts are per part: ``kept`` after the step, ``removed`` by it, ``redundant`` rows that fail
    its filter but were removed before (those in its id table that the semi-join does not find among the
    survivors), ``unique_fails`` rows that fail its filter only, ``shapley`` the filter's removals added up
    over all orders.

    The number of sets doubles with each filter, and so does the work; the number of orders only decides
    how many rows the result has. All steps run when this is called; what is left is a join of counts."""
    spark, names = rows.sparkSession, list(failing)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept, removed, tables = None, None, []
    try:
        for name in names:
            ids = failing[name].select("id", "part")
            tables.append(write_buckets(ids, "id", buckets, f"failing_{len(tables)}"))
        of_kind = [df.select("id", "part", F.lit(kind).alias("kind")) for kind, df in {ALL: rows, **kinds}.items()]
        universe = _union(of_kind).withColumn("prefix", F.lit(0))
        fails = _union([t.rows.groupBy("part").agg(F.count("*").alias("fails")).withColumn("filter", F.lit(k)) for k, t in enumerate(tables)])
        fails = written(fails, "audit-fails")
        kept, removed = _survivors(write_buckets(universe, "id", buckets, "audit_level"), tables, buckets)
    finally:
        for table in tables:
            table.drop()

    def n_of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("n")))

    steps = [
        ("".join(order), k + 1, names.index(f), sum(1 << names.index(x) for x in order[:k]))
        for order in permutations(names)
        for k, f in enumerate(order)
    ]
    shape = "array<struct<filter_order: string, step: int, filter: int, prefix: int>>"
    named = [dict(zip(("filter_order", "step", "filter", "prefix"), s, strict=True)) for s in steps]
    parts = kept.filter("prefix = 0").select("part").distinct()
    every = parts.select("part", F.inline(F.from_json(F.lit(json.dumps(named)), shape)))
    after = kept.filter(F.col("kind") == ALL).select("part", F.col("prefix").alias("after"), F.col("n").alias("kept"))
    losses = removed.groupBy("part", "filter", "prefix").agg(n_of(ALL).alias("removed"), *[n_of(kind).alias(f"{kind}_lost") for kind in kinds])
    m = len(names)
    weight = {size: factorial(size) * factorial(m - 1 - size) for size in range(m)}
    weights = F.element_at(F.array(*[F.lit(weight[size]) for size in range(m)]), F.bit_count("prefix") + 1)
    bit = F.call_function("shiftleft", F.lit(1), F.col("filter"))
    only = F.col("prefix") + bit == (1 << m) - 1
    total = losses.groupBy("part", "filter").agg(
        F.sum(F.col("removed") * weights).alias("shapley"), F.sum(F.when(only, F.col("removed"))).alias("unique_fails")
    )
    joined = (
        every.withColumn("after", F.col("prefix").bitwiseOR(bit))
        .join(after, ["part", "after"], "left")
        .join(losses, ["part", "filter", "prefix"], "left")
        .join(fails, ["part", "filter"], "left")
        .join(total, ["part", "filter"], "left")
    )
    gone = _number(F.col("removed"))
    return joined.select(
        "part",
        "filter_order",
        "step",
        _number(F.col("kept")).alias("kept"),
        gone.alias("removed"),
        (_number(F.col("fails")) - gone).alias("redundant"),
        _number(F.col("unique_fails")).alias("unique_fails"),
        *[_number(F.col(f"{kind}_lost")).alias(f"{kind}_lost") for kind in kinds],
        _number(F.col("shapley")).alias("shapley"),
    )


# ---------------------------------------------------------------- the filters of documents


def _failures(text: Column) -> dict[str, Column]:
    """Filters that a text alone decides."""
    words = F.array_remove(F.split(text, SPACES), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of five filters over documents (doc_id, text, lang), by language. A row fails A with under
    200 words, B with under half of its words distinct, C with over 3 % of its code points A to Z, D with
    one of ``#$%&*|``, E if a row of a smaller doc_id has the same text. Losses are counted of rows
    that ``labels`` (doc_id, quality, toxic) marks good (quality 1) and toxic (toxic 1).

    Nulls: a null text is the empty text, a null lang the part ''; a row without a doc_id is neither smaller
    nor larger than another and has no label. Empty texts have no words: they fail A, not B or C.
    Repeated rows count as often as they come; rows of equal doc_id and text fail E only if a smaller id
    has the text. Repeated labels: one that marks is enough; null marks do not. Very long texts are
    read whole. Empty table: no rows. Other columns are not read. Texts are equal if their SHA-256 is."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("key"),
        *[fails.alias(name) for name, fails in _failures(text).items()],
    )
    rows = written(rows, "audit-rows")
    copies = rows.groupBy("key").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1")
    failing = {name: rows.filter(name) for name in "ABCD"}
    failing["E"] = rows.join(copies, "key").filter("doc_id > least")
    marks = {"good": labels.filter("quality = 1"), "toxic": labels.filter("toxic = 1")}
    kinds = {kind: rows.join(marked.select("doc_id").distinct(), "doc_id", "left_semi") for kind, marked in marks.items()}
    return audit(rows, failing, kinds)

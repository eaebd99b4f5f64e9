"""The corpus pipeline: stages over the documents table, each written and read again.

Every stage takes null ids, null, empty and very long texts, repeated rows, empty tables and further columns of
any name; all but the last return the columns they got. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.llm.common import release, table, written
from parcelmart.llm.decontaminate import without_leaks
from parcelmart.llm.line_dedup import dedup_lines
from parcelmart.llm.ngram_join import one_of_each
from parcelmart.llm.pieces import encode_texts
from parcelmart.llm.quality import remainder, score_quality

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5 go. Learned as in the query op4: labels of ids
    whose remainder is 1 are left for measuring. Null and empty texts have the share of label 1 as their score;
    repeated rows go or stay together; a score of 0.5 stays, as do all rows without a usable label."""
    release(spark)
    name = "score of the quality classifier"
    scored = score_quality(docs, table(spark, sf_dir, "labels"), remainder(F.col("key"), 3) != 1, docs.columns, name)
    return scored.filter(F.col(f"`{name}`") >= 0.5).drop(name)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go; n_chars follows the text. Every row stays: null texts null, others
    perhaps empty. Earlier is by id (null first), line and hash of the text; rows alike in id and text lose the
    same lines, and of equal texts without an id the first keeps them."""
    release(spark)
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates one document stays, the one of the smallest id (null last), then of the
    smallest hash of its text, once. Texts without a word are in no group and stay."""
    release(spark)
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go, each row by its own text: null and empty texts hold none, and rows
    that share an id, or have none, go or stay by themselves."""
    release(spark)
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of what is left, a row for each row. Null and empty texts have no pieces."""
    release(spark)
    encoded = encode_texts(docs, ["doc_id"])
    return encoded.select("doc_id", F.size("ids").alias("n_ids"), "ids", "round_trip")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", classify),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_copies),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding and decoding", encode),
]

#: SQL cannot express the classifier and the encoder; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "corpus-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

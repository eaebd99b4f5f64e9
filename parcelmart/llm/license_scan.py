"""Licence scan: canonical digests of entire texts, looked up among known licences.

Two texts are the same licence when they agree after normalising: lower case; lines that state a
copyright or name its holder dropped; everything but letters and digits taken as a blank; equivalent spellings made
one. The digest of the result joins with the digests of the known texts. Short notices that stand as
a line of their own are found in the same way, line by line. Built-in expressions only.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmart.llm.licence_texts import MORE_NOTICES, NOTICES, SPELLINGS, published_texts

# A line that states a copyright: the word or sign, then a sign, a year or a place holder for one.
COPYRIGHT_LINE = r"(?m)^[^\p{L}\p{N}\n(]*(?:copyright|©|\(c\))[ \t:,]*(?:©|\(c\)|[0-9]{4}|[<\[{])[^\n]*$"
# A line that names a holder only: the word as it begins a line of its own, then a name and no word of the law.
HOLDER_LINE = (
    r"(?m)^[^\p{L}\p{N}\n(]*Copyright[ \t:,]+(?:(?i:by|the)[ \t]+)?+"
    r"(?!(?i:act|disclaimer|holder|infring|interest|law|licen|notice|office|owner|permission|protect|right|statement|treat)\p{L}*)"
    r"(?:\p{Lu}|contributors\b|authors\b)[^\n]*$"
)
RESERVED_LINE = r"(?m)^[^\p{L}\p{N}\n]*all rights reserved[^\p{L}\p{N}\n]*$"
NO_WORD = r"[^\p{L}\p{N}\n]+"

# A cheap test for texts in which any spelling could change: stems that stand in all of them.
STEMS = (
    "licen|offen|sub|dgement|ogue|analyse|artefact|isa|ise|isi|calibre|centre|lled|lling|avour|abour|fulfil|non|copyright owner|"
    "practis|programme|whilst|wil|per cent|http"
)


# One of these stands in nearly all notices.
NOTICE_STEMS = ["licen", "domain"]


def _java(replacement: str) -> str:
    return re.sub(r"\\([0-9])", r"$\1", replacement)


def canonical(text: Column) -> Column:
    """The text in canonical form, line by line. Null gives null."""
    unnamed = F.when(F.contains(text, F.lit("Copyright")), F.regexp_replace(text, HOLDER_LINE, "")).otherwise(text)
    lowered = F.lower(unnamed)
    dropped = F.when(
        F.contains(lowered, F.lit("copyright")) | F.contains(lowered, F.lit("©")) | F.contains(lowered, F.lit("(c)")),
        F.regexp_replace(lowered, COPYRIGHT_LINE, ""),
    ).otherwise(lowered)
    dropped = F.when(F.contains(dropped, F.lit("all rights reserved")), F.regexp_replace(dropped, RESERVED_LINE, "")).otherwise(dropped)
    return F.regexp_replace(dropped, NO_WORD, " ")


def _spelled(plain: Column) -> Column:
    spelled = plain
    for pattern, replacement in SPELLINGS.items():
        spelled = F.regexp_replace(spelled, pattern, _java(replacement))
    return F.when(plain.rlike(STEMS), spelled).otherwise(plain)


def _whole(lines: Column) -> Column:
    """Canonical lines as one line."""
    return F.trim(F.regexp_replace(lines, "[ \n]+", " "))


def _notice(line: str) -> str:
    plain = re.sub(r"[^\w\n]+|_+", " ", line.lower()).strip()
    for pattern, replacement in SPELLINGS.items():
        plain = re.sub(pattern, replacement, plain)
    return plain


def known_texts(spark: SparkSession, more: list[tuple[str, str]] = ()) -> DataFrame:
    """The table (name, text) of the licences known here, and of those that the caller adds. A name may
    have several texts."""
    return spark.createDataFrame([*published_texts(), *more], "name string, text string")


def _holding(line: Column, keys: list[str]) -> Column:
    """A cheap test for lines that may be one of ``keys``."""
    stems = sorted({next((s for s in NOTICE_STEMS if s in key), key) for key in keys})
    return reduce(or_, (F.contains(line, F.lit(s)) for s in stems), F.lit(False))


def known_digests(known: DataFrame) -> DataFrame:
    """(digest, licence) of known texts (name, text); of names with the same digest the smallest.
    Texts without a word are left out."""
    whole = _spelled(_whole(canonical(F.col("text"))))
    return (
        known.select("name", whole.alias("whole"))
        .filter("whole <> ''")
        .groupBy(F.sha2("whole", 256).alias("digest"))
        .agg(F.min("name").alias("licence"))
    )


def scan_licences(
    docs: DataFrame,
    known: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    notices: dict[str, str] = NOTICES | MORE_NOTICES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest of the canonical text, licence (the known text that
    the entire text is, or null) and notices (the licences that notice lines name, sorted, joined by
    commas; '' without any). ``known`` is a table such as ``known_texts``, and ``notices`` gives the
    licence that each notice line names; callers may extend both.

    Null, empty and wordless texts have a null digest. Repeated rows give equal rows. Only the named
    columns are read; an empty table gives no rows, an empty ``known`` no licences.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), canonical(F.col(text).cast("string")).alias("lines"))
    names = {_notice(line): name for line, name in sorted(notices.items())}
    named = F.create_map(*(F.lit(x) for item in names.items() for x in item)).cast("map<string,string>")
    longest = 2 * max(map(len, names), default=0)  # no spelling is twice as long as its equal
    lines = F.transform(F.split("lines", "\n", -1), lambda x: F.trim(x))
    short = F.filter(lines, lambda x: (F.length(x) <= longest) & _holding(x, list(names)))
    found = F.array_sort(F.array_distinct(F.filter(F.transform(short, lambda x: F.element_at(named, _spelled(x))), lambda x: x.isNotNull())))
    scanned = rows.select(
        "doc_id",
        _spelled(_whole(F.col("lines"))).alias("whole"),
        F.coalesce(F.array_join(found, ","), F.lit("")).alias("notices"),
    ).select("doc_id", F.when(F.col("whole") != "", F.sha2("whole", 256)).alias("digest"), "notices")
    return scanned.join(known_digests(known), "digest", "left").select("doc_id", "digest", "licence", "notices")

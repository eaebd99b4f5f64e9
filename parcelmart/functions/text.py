"""Text cleaning and keyword rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelmart.schemas import (
    CANCEL_WORDS,
    COD,
    COD_FLAG_WORDS,
    NO_REASON,
    NO_VALUE,
    NON_COD,
    NULL_WORDS,
    STATUS_FINAL,
)

# All Unicode white space; Spark's plain trim removes only the blank.
WHITE_SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# JSON scalars are read as text, so these are the texts of an unset value.
UNSET_TEXTS = ["", "0", "0.0", "false"]


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(WHITE_SPACE))


def clean_text(c: Column, fallback: str = NO_VALUE, strict: bool = False) -> Column:
    """Stripped text; ``fallback`` for null and blank, and with ``strict`` also
    for the words that stand for a missing value."""
    text = strip(c.cast("string"))
    present = ~text.rlike(f"(?i)^({'|'.join(NULL_WORDS)}|)$") if strict else text != ""
    return F.coalesce(F.when(present, text), F.lit(fallback))


def is_set(c: Column) -> Column:
    return c.isNotNull() & ~c.isin(UNSET_TEXTS)


def first_set(*cs: Column) -> Column:
    """The first value that is set; the last one is taken as it is."""
    *head, last = cs
    return F.coalesce(*[F.when(is_set(c), c) for c in head], last)


def shortest_keywords(words: list[str]) -> list[str]:
    """Drop words that contain another word of the list: they add no matches."""
    return [w for w in dict.fromkeys(words) if not any(o != w and o in w for o in words)]


def contains_any(text: Column, words: list[str]) -> Column:
    """One pattern, so that the text expression appears once: a filter on the result
    may be pushed through the projections that compute the text, and copies it."""
    return text.rlike("|".join(rf"\Q{w}\E" for w in shortest_keywords(words)))


def keyword_match(c: Column, include: list[str], exclude: list[str]) -> Column:
    """True where the upper-cased text holds an included and no excluded keyword."""
    text = F.upper(c)
    return F.coalesce(contains_any(text, include) & ~contains_any(text, exclude), F.lit(False))


def cancel_keyword(*cs: Column) -> Column:
    """1 where any of the texts speaks of a cancellation."""
    text = F.lower(F.concat_ws(" ", *cs))
    return contains_any(text, CANCEL_WORDS).cast("int")


def final_status(c: Column) -> Column:
    return F.lower(clean_text(c, fallback="")).isin(STATUS_FINAL).cast("int")


def service_bucket(c: Column) -> Column:
    text = clean_text(c)
    low = F.lower(text)
    return (
        F.when(contains_any(low, ["eco", "hemat"]), F.lit("Eco"))
        .when(contains_any(low, ["standard", "regular"]), F.lit("Standard"))
        .otherwise(text)
    )


# Leading slashes and blanks are taken possessively, so that an empty part is
# never counted as one. Regular expressions, and not split + filter, because
# lambda functions would end whole-stage code generation.
_FIRST_PART = r"(?U)^[\s\x1c-\x1f/]*+([^/]+)"
_SECOND_PART = r"(?U)^[\s\x1c-\x1f/]*+[^/]+/[\s\x1c-\x1f/]*+([^/]+)"


def region_text(cleaned: Column, part: int) -> Column:
    """Part 1 (province) or 2 (city) of a cleaned ``a / b / c`` region text, as it stands there."""
    return F.regexp_extract(cleaned, {1: _FIRST_PART, 2: _SECOND_PART}[part], 1)


def region_part(cleaned: Column, part: int) -> Column:
    """The same, cleaned."""
    return clean_text(region_text(cleaned, part))


def split_region(c: Column) -> tuple[Column, Column]:
    """(province, city): the first two non-empty parts."""
    cleaned = clean_text(c, strict=True)
    return region_part(cleaned, 1), region_part(cleaned, 2)


def cod_payment_role(c: Column) -> tuple[Column, Column]:
    """(payment text, COD type) of a payment-role text."""
    text = clean_text(c, strict=True)
    low = F.lower(text)
    is_cod = contains_any(low, ["cod"]) & ~contains_any(low, ["non"])
    return text, F.when(is_cod, F.lit(COD)).otherwise(F.lit(NON_COD))


def cod_type(amount: Column, flag: Column) -> Column:
    """COD where money is collected or the flag says so."""
    says_cod = F.lower(clean_text(flag, fallback="", strict=True)).isin(COD_FLAG_WORDS)
    return F.when((amount > 0) | says_cod, F.lit(COD)).otherwise(F.lit(NON_COD))


def reason_code_text(latest: Column, code: Column) -> Column:
    """Return reason from the latest tracking text, else from the reason code."""
    # Which texts give way to the code, and which mean "no reason".
    raw = F.when(latest.isNull() | latest.isin("", "0", "0.0"), code).otherwise(latest)
    text = clean_text(raw)
    return (
        F.when(text.isin("0", "unknown", "Unknown", "None"), F.lit(NO_REASON))
        .when(text.rlike("^[0-9]+$"), F.concat(F.lit("Reason Code "), text))
        .otherwise(text)
    )

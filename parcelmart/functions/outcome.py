"""Return classification of an export row: ordered rules, first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelmart.functions.text import contains_any
from parcelmart.schemas import (
    CANCEL_WORDS,
    CANCELLED,
    NO_REASON,
    STATUS_DELIVERED,
    STATUS_IN_PROGRESS,
    STATUS_LOSS,
    STATUS_RETURN,
)

R_CANCELLED, R_DELIVERED, R_RETURNED, R_LOST, R_FAILED, R_FAILED_OPEN, R_NONE = range(1, 8)


def outcome_rule(returned_at: Column, failed: Column, delay: Column, status: Column) -> Column:
    """Number of the rule that decides. Arguments are strictly cleaned texts with an
    empty text for missing; ``returned_at`` counts by being there, not by its date."""
    low = F.lower(status)
    words = F.lower(F.concat_ws(" ", status, failed, delay))
    return (
        F.when(contains_any(words, CANCEL_WORDS), R_CANCELLED)
        .when(low.isin(STATUS_DELIVERED), R_DELIVERED)
        .when((returned_at != "") | low.isin(STATUS_RETURN), R_RETURNED)
        .when(low.isin(STATUS_LOSS), R_LOST)
        .when((failed != "") & ~low.isin(STATUS_IN_PROGRESS), R_FAILED)
        .when(failed != "", R_FAILED_OPEN)
        .otherwise(R_NONE)
    )


def outcome_flag(rule: Column) -> Column:
    return rule.isin(R_RETURNED, R_LOST, R_FAILED).cast("int")


def outcome_reason(rule: Column, failed: Column, delay: Column, status: Column) -> Column:
    texts = [F.when(c != "", c) for c in (failed, delay, status)]
    first_text = F.coalesce(*texts, F.lit(NO_REASON))
    by_rule = {
        R_CANCELLED: F.lit(CANCELLED),
        R_DELIVERED: F.lit(NO_REASON),
        R_RETURNED: first_text,
        R_LOST: first_text,
        R_FAILED: failed,
        R_FAILED_OPEN: failed,
        R_NONE: F.lit(NO_REASON),
    }
    return F.elt(rule, *[by_rule[r] for r in sorted(by_rule)])

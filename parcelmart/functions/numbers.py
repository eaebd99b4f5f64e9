"""Number parsing, ratios and number texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelmart.functions.text import strip
from parcelmart.schemas import MONEY

# A cast alone would also take '1d', '1f', 'nan' and hexadecimal texts.
NUMERIC = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def parse_number(c: Column) -> Column:
    """Text to double: every comma is dropped; 0.0 for what is no finite number.

    The input stands in the expression once: written twice, all of it would run twice. The remainder
    by infinity is the number itself, and NaN where that is infinite."""
    text = strip(F.translate(c.cast("string"), ",", ""))
    value = F.regexp_extract(text, NUMERIC, 0).try_cast("double")
    return F.coalesce(F.nanvl(value % F.lit(float("inf")), F.lit(0.0)), F.lit(0.0))


def to_money(value: Column) -> Column:
    """Decimal, so that sums do not depend on the row order. Null beyond the range of the type (22
    digits before the point): the amount is not taken for 0, and the quality checks count it."""
    return F.when(value.isNull(), F.lit(0).cast(MONEY)).otherwise(value.try_cast(MONEY))


def parse_money(c: Column) -> Column:
    return parse_number(c).try_cast(MONEY)  # never null before the cast, so no check copies the parsing


def safe_ratio(n: Column, d: Column) -> Column:
    """n / d as double, 0.0 where d is zero or missing."""
    return F.coalesce(F.try_divide(n.cast("double"), d.cast("double")), F.lit(0.0))


def decimal_comma(c: Column) -> Column:
    """Six decimals with a decimal comma; empty for null and NaN.

    ``format_number`` rounds the exact binary value half-even, as C's printf does;
    ``format_string`` rounds the shortest decimal text half-up and differs on ties."""
    text = F.translate(F.format_number(c, 6), ".,", ",")
    return F.when(c.isNull() | F.isnan(c), F.lit("")).otherwise(text)

"""Time parsing and calendar keys.

Times are TIMESTAMP_NTZ: a wall-clock reading that no session time zone moves.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelmart.functions.numbers import NUMERIC
from parcelmart.functions.text import strip

NTZ = "timestamp_ntz"

_YEAR_FIRST = r"^\d{4}-"
_YEAR_LAST = r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4})(\D.*)?$"
_DAY_MONTH = "$4-$3-$1$5"
_MONTH_DAY = "$4-$1-$3$5"

# Unix seconds of the years 1 to 9999.
_MIN_SECONDS, _MAX_SECONDS = -62135596800, 253402300799


def _parse_text(text: Column, *year_last_orders: str) -> Column:
    """Year-first texts are ISO. Year-last texts are rewritten to ISO, trying the
    given orders. One cast per order: no formatter, and no exception per bad row."""
    rewritten = [
        F.regexp_replace(text, _YEAR_LAST, order).try_cast(NTZ) for order in year_last_orders
    ]
    return F.when(text.rlike(_YEAR_FIRST), text.try_cast(NTZ)).when(
        text.rlike(_YEAR_LAST), F.coalesce(*rewritten)
    )


# What a text of one of the other shapes has: a day, month or year number first, or a month name.
_RARE = r"(?i)^(\d{1,4}[/.\s-]|\d{8}$|[a-z]{3,9}\.?\s+\d)"

# Fixed value: the months by their first three letters.
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

_HALF_DAY = r"(?i)^(.*?)(\d{1,2})((?::\d{1,2}){0,2})\s*([ap])\.?m\.?$"
_YEAR_FIRST_OTHER = r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})(\D.*)?$"
_COMPACT = r"^(\d{4})(\d{2})(\d{2})$"
_DAY_NAME = r"(?i)^(\d{1,2})[\s.-]+([a-z]{3,9})\.?[\s,-]+(\d{4})(\D.*)?$"
_NAME_DAY = r"(?i)^([a-z]{3,9})\.?\s+(\d{1,2}),?\s+(\d{4})(\D.*)?$"
_SHORT_YEAR = r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{2})(\D.*)?$"


def _part(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group)


def _of_24_hours(text: Column) -> Column:
    """A time that ends in AM or PM, with the hour of the whole day."""
    hour = _part(text, _HALF_DAY, 2).try_cast("int")
    afternoon = F.lower(_part(text, _HALF_DAY, 4)) == "p"
    whole = F.when(hour.between(1, 12), hour % 12 + F.when(afternoon, 12).otherwise(0))
    minutes = _part(text, _HALF_DAY, 3)
    # a bare hour needs minutes to be read as a time
    return F.concat(
        _part(text, _HALF_DAY, 1), F.lpad(whole.cast("string"), 2, "0"), F.when(minutes == "", ":00").otherwise(minutes)
    )


def _named(text: Column, pattern: str, name: int, day: int) -> Column:
    at = F.instr(F.lit(_MONTHS), F.lower(F.substring(_part(text, pattern, name), 1, 3)))
    month = F.when((at > 0) & (at % 3 == 1), ((at + 2) / 3).cast("int"))
    return F.concat(
        _part(text, pattern, 3), F.lit("-"), month.cast("string"), F.lit("-"), _part(text, pattern, day), _part(text, pattern, 4)
    )


def _with_iso_date(text: Column) -> Column:
    """Other date shapes brought to those that ``_parse_text`` reads: year first with slashes or
    points, eight digits, English month names, years of two digits (00-68 are 20xx)."""
    century = F.when(_part(text, _SHORT_YEAR, 4) <= "68", "20").otherwise("19")
    return (
        F.when(text.rlike(_YEAR_FIRST_OTHER), F.regexp_replace(text, _YEAR_FIRST_OTHER, "$1-$2-$3$4"))
        .when(text.rlike(_COMPACT), F.regexp_replace(text, _COMPACT, "$1-$2-$3"))
        .when(text.rlike(_DAY_NAME), _named(text, _DAY_NAME, 2, 1))
        .when(text.rlike(_NAME_DAY), _named(text, _NAME_DAY, 1, 2))
        .when(
            text.rlike(_SHORT_YEAR),
            F.concat(
                F.regexp_replace(text, _SHORT_YEAR, "$1$2$3$2"), century, F.regexp_replace(text, _SHORT_YEAR, "$4$5")
            ),
        )
        .otherwise(text)
    )


def parse_ts_dayfirst(c: Column) -> Column:
    """Export times: day before month, month first only where that is impossible. Year-first
    texts are ISO in order whatever their separator. Texts of the usual shapes are read as they are;
    only the others are rewritten first."""
    text = strip(c.cast("string"))
    usual = _parse_text(text, _DAY_MONTH, _MONTH_DAY)
    # Each step stands in a function of one variable: written out, the nested texts would make
    # code that is too large to compile.
    rare = _bound(text, lambda t: F.when(t.rlike(_HALF_DAY), _of_24_hours(t)).otherwise(t))
    rare = _bound(_bound(rare, _with_iso_date), lambda t: _parse_text(t, _DAY_MONTH, _MONTH_DAY))
    return F.coalesce(usual, F.when(text.rlike(_RARE), rare))


def _bound(value: Column, function: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), function), F.lit(0))


def parse_ts_api(c: Column) -> Column:
    """API times: a number is Unix seconds in UTC, a text is ISO or month-first."""
    text = strip(c.cast("string"))
    seconds = text.try_cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast(NTZ)
    from_number = F.when(
        seconds.between(_MIN_SECONDS, _MAX_SECONDS), epoch + F.make_dt_interval(secs=seconds)
    )
    return F.when(text.rlike(NUMERIC), from_number).otherwise(
        _parse_text(text, _MONTH_DAY, _DAY_MONTH)
    )


def date_text(c: Column) -> Column:
    """yyyy-MM-dd, or the stripped input where it is no date."""
    parsed = F.date_format(parse_ts_dayfirst(c), "yyyy-MM-dd")
    return F.coalesce(parsed, strip(c.cast("string")))


def week_keys(date: Column, iso_year: bool = False) -> dict[str, Column]:
    """Year and ISO week. The year is the calendar year, so 2024-12-30 falls in
    (2024, 1); with ``iso_year`` it is the year that owns the week."""
    year = F.extract(F.lit("YEAROFWEEK"), date).cast("int") if iso_year else F.year(date)
    return {"year": year, "week_of_year": F.weekofyear(date)}


def quarter_range(date: Column) -> tuple[Column, Column]:
    """First and last day of the date's quarter."""
    start = F.trunc(date, "quarter")
    return start, F.last_day(F.add_months(start, 2))


def quarter_of(day: dt.date) -> tuple[dt.date, dt.date]:
    """First and last day of the quarter, for a load window fixed before the job."""
    first_month = (day.month - 1) // 3 * 3 + 1
    start = day.replace(month=first_month, day=1)
    next_start = (start + dt.timedelta(days=95)).replace(day=1)
    return start, next_start - dt.timedelta(days=1)


def week_of(day: dt.date, iso_year: bool = False) -> tuple[int, int]:
    iso = day.isocalendar()
    return (iso.year if iso_year else day.year), iso.week


def whole_week_ranges(
    start: dt.date, end: dt.date, iso_year: bool = False
) -> list[tuple[dt.date, dt.date]]:
    """Date ranges that hold every day of every (year, week) key met in the window.

    A window edge may cut a week, and a calendar-year key may hold days at both ends
    of a year; replacing such a week from the window alone would lose the other days."""
    one = dt.timedelta(days=1)
    keys = {week_of(start + i * one, iso_year) for i in range((end - start).days + 1)}
    day, last = dt.date(start.year, 1, 1) - 7 * one, dt.date(end.year, 12, 31) + 7 * one
    ranges: list[tuple[dt.date, dt.date]] = []
    while day <= last:
        if week_of(day, iso_year) in keys:
            if ranges and ranges[-1][1] == day - one:
                ranges[-1] = (ranges[-1][0], day)
            else:
                ranges.append((day, day))
        day += one
    return ranges

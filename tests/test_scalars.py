"""Edge values of the scalar rules, as literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelmart.functions import dates, numbers, outcome, text
from parcelmart.schemas import NOT_RETURN_WORDS, RETURN_WORDS


def x():
    return F.col("x")


def apply(spark, values, *columns, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    rows = df.select("i", *[c.alias(f"r{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    return [r[1] if len(columns) == 1 else tuple(r[1:]) for r in rows]


def check(spark, cases, *columns, kind="string"):
    assert apply(spark, [v for v, _ in cases], *columns, kind=kind) == [e for _, e in cases]


def test_clean_text_basic(spark):
    check(
        spark,
        [(None, "No Value"), ("", "No Value"), (" \t ", "No Value"), ("nan", "nan"),
         ("　\tx y \x1c\n", "x y")],
        text.clean_text(x()),
    )


def test_clean_text_strict(spark):
    missing = [None, "", "  ", "NaN", "NaT", "None", "NULL", " nan\n"]
    check(
        spark,
        [(v, "-") for v in missing] + [("\tnano\n", "nano"), ("none of", "none of")],
        text.clean_text(x(), "-", strict=True),
    )


def test_parse_number(spark):
    zero = ["-", "", None, "Rp 10", "1d", "1f", "nan", "inf", "-Infinity", "1e999", "0x1p3", "1 2"]
    cases = [("1,234.50", 1234.5), ("1.234,56", 1.23456), (" 5 ", 5.0), ("1e3", 1000.0),
             (".5", 0.5), ("+5", 5.0), ("-3.", -3.0), ("1,2,3", 123.0)]
    check(spark, cases + [(v, 0.0) for v in zero], numbers.parse_number(x()))


def test_money_out_of_range_is_missing_and_other_amounts_are_kept(spark):
    got = apply(spark, ["1e23", "12.345", "1e17", None, "x"], numbers.parse_money(x()).cast("string"))
    assert got == [None, "12.345000", "100000000000000000.000000", "0.000000", "0.000000"]


def test_parse_ts_dayfirst_of_other_shapes(spark):
    t = dt.datetime
    cases = [
        ("2026/03/04", t(2026, 3, 4)), ("2026.3.4 10:30", t(2026, 3, 4, 10, 30)), ("20260304", t(2026, 3, 4)),
        ("04/03/2026 10:00 AM", t(2026, 3, 4, 10)), ("04/03/2026 12:05:06 am", t(2026, 3, 4, 0, 5, 6)),
        ("4-3-2026 1:15 p.m.", t(2026, 3, 4, 13, 15)), ("2026-03-04 12 PM", t(2026, 3, 4, 12)), ("4 Mar 2026", t(2026, 3, 4)),
        ("04-MAR-2026 08:00", t(2026, 3, 4, 8)), ("March 4, 2026", t(2026, 3, 4)), ("Sept. 30 1999", t(1999, 9, 30)),
        ("04/03/26", t(2026, 3, 4)), ("04.03.99 07:08", t(1999, 3, 4, 7, 8)), ("4 Mars Street", None), ("4 Foo 2026", None),
        ("04/03/2026 13:00 PM", None), ("31/31/26", None), ("2026/13/40", None), ("20261340", None),
    ]
    check(spark, cases, dates.parse_ts_dayfirst(x()))


def test_parse_ts_dayfirst(spark):
    t = dt.datetime
    cases = [
        ("04/03/2026", t(2026, 3, 4)), ("13/02/2026", t(2026, 2, 13)), ("02/13/2026", t(2026, 2, 13)),
        ("04-03-2026 08:00", t(2026, 3, 4, 8)), ("2026-03-04", t(2026, 3, 4)),
        ("4/3/2026 7:8:9", t(2026, 3, 4, 7, 8, 9)), ("04.03.2026", t(2026, 3, 4)),
        ("2026-03-04T08:00:01", t(2026, 3, 4, 8, 0, 1)), (" 2026-03-04 08:00 ", t(2026, 3, 4, 8)),
        ("2026-03-04T08:00:00+07:00", t(2026, 3, 4, 8)),
        ("-", None), ("garbage", None), ("45000", None), ("", None), (None, None), ("31/02/2026", None),
    ]
    check(spark, cases, dates.parse_ts_dayfirst(x()))


def test_parse_ts_api(spark):
    t = dt.datetime
    cases = [
        ("1767225600", t(2026, 1, 1)), ("", None), (None, None), ("0", t(1970, 1, 1)),
        ("1767225600.5", t(2026, 1, 1, 0, 0, 0, 500000)), ("1e30", None), ("-86400", t(1969, 12, 31)),
        ("2026-03-04 05:06:07", t(2026, 3, 4, 5, 6, 7)), ("03/04/2026", t(2026, 3, 4)), ("soon", None),
    ]
    check(spark, cases, dates.parse_ts_api(x()))


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
        check(spark, [("1767225600", "2026-01-01")], dates.parse_ts_api(x()).cast("date").cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_date_text(spark):
    check(spark, [("04/03/2026", "2026-03-04"), (" soon ", "soon"), ("", "")], dates.date_text(x()))


def test_week_keys(spark):
    d = dt.date
    cases = [(d(2026, 1, 1), (2026, 1)), (d(2024, 12, 30), (2024, 1)), (d(2027, 1, 1), (2027, 53)),
             (d(2021, 1, 3), (2021, 53)), (None, (None, None))]
    check(spark, cases, *dates.week_keys(x()).values(), kind="date")
    iso = dates.week_keys(x(), iso_year=True)
    check(spark, [(d(2024, 12, 30), (2025, 1)), (d(2027, 1, 1), (2026, 53))], *iso.values(), kind="date")


def test_split_region(spark):
    none = "No Value"
    cases = [("A / B / C", ("A", "B")), ("A", ("A", none)), ("/ /", (none, none)), ("A//B", ("A", "B")),
             (None, (none, none)), ("/ /A", ("A", none)), ("A / /", ("A", none)), (" nan ", (none, none)),
             ("/A/ /B/C", ("A", "B")), ("DKI Jakarta / Kota / x", ("DKI Jakarta", "Kota"))]
    check(spark, cases, *text.split_region(x()))


def test_service_bucket(spark):
    cases = [("Hemat", "Eco"), ("second day", "Eco"), ("REGULAR", "Standard"), ("Drop Off", "Drop Off"),
             (None, "No Value"), ("standard eco", "Eco")]
    check(spark, cases, text.service_bucket(x()))


def test_cod_payment_role(spark):
    cases = [("Non-COD", ("Non-COD", "NON-COD")), ("cod", ("cod", "COD")), (None, ("No Value", "NON-COD")),
             ("Sender", ("Sender", "NON-COD"))]
    check(spark, cases, *text.cod_payment_role(x()))


def test_cod_type(spark):
    rows = spark.createDataFrame(
        [(0, 0.0, "TRUE"), (1, 5.0, "N"), (2, 0.0, "N"), (3, 0.0, None), (4, 0.0, " cod ")],
        "i int, a double, f string",
    )
    got = rows.select("i", text.cod_type(F.col("a"), F.col("f")).alias("c")).orderBy("i").collect()
    assert [r.c for r in got] == ["COD", "COD", "NON-COD", "NON-COD", "COD"]


def test_cancel_keyword(spark):
    rows = [("Dibatalkan", None, None, None), ("CANCELED", "", "", ""), ("", "order batal", None, None),
            (None, None, None, "cancel"), (None,) * 4, ("Delivered", "x", "y", "z")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, c string, d string")
    got = df.select("i", text.cancel_keyword(*[F.col(c) for c in "abcd"]).alias("k")).orderBy("i").collect()
    assert [r.k for r in got] == [1, 1, 1, 1, 0, 0]


def test_final_status(spark):
    cases = [(" Delivered ", 1), ("returning", 0), ("", 0), (None, 0), ("LOST", 1), ("damaged", 1), ("Returned", 1)]
    check(spark, cases, text.final_status(x()))


def test_keyword_match(spark):
    cases = [("Return to sender", True), ("IN PROCESS RETURN", False), ("parts", True), ("Delivered", False),
             (None, False), ("cancelled by courier (refused)", True), ("cancelled by courier", False)]
    check(spark, cases, text.keyword_match(x(), RETURN_WORDS, NOT_RETURN_WORDS))


def test_shortest_keywords():
    assert text.shortest_keywords(["cancel", "cancelled", "batal", "dibatalkan", "batal"]) == ["cancel", "batal"]


def test_reason_code_text(spark):
    rows = [("0", "12", "Reason Code 12"), ("", "unknown", "No Reason Provided"), (None, None, "No Value"),
            ("late", "7", "late"), (None, "0", "No Reason Provided"), ("None", "7", "No Reason Provided")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string, e string")
    got = df.select("e", text.reason_code_text(F.col("a"), F.col("b")).alias("r")).collect()
    assert all(r.e == r.r for r in got), got


RULES = [
    # returned_at, failed, delay, status -> rule, flag, reason
    (("2026-01-01", "", "", "Delivered"), (2, 0, "No Reason Provided")),
    (("2026-01-01", "", "", "Cancelled"), (1, 0, "Cancelled")),
    (("", "dibatalkan", "", "Returned"), (1, 0, "Cancelled")),
    (("soon", "", "rain", "On Hold"), (3, 1, "rain")),
    (("", "", "", "Returning"), (3, 1, "Returning")),
    (("", "", "", "lost"), (4, 1, "lost")),
    (("", "refused", "", "Delivery Failed"), (5, 1, "refused")),
    (("", "refused", "", ""), (5, 1, "refused")),
    (("", "refused", "", "On Hold"), (6, 0, "refused")),
    (("", "", "rain", "In Transit"), (7, 0, "No Reason Provided")),
    (("2026-01-01", "", "", ""), (3, 1, "No Reason Provided")),
]


@pytest.mark.parametrize("given, expected", RULES)
def test_outcome(spark, given, expected):
    df = spark.createDataFrame([given], "returned string, failed string, delay string, status string")
    cols = [F.col(c) for c in df.columns]
    rule = outcome.outcome_rule(*cols)
    row = df.select(rule, outcome.outcome_flag(rule), outcome.outcome_reason(rule, *cols[1:])).first()
    assert tuple(row) == expected


def test_quarter_range(spark):
    d = dt.date
    cases = [(d(2026, 2, 10), (d(2026, 1, 1), d(2026, 3, 31))), (d(2026, 12, 31), (d(2026, 10, 1), d(2026, 12, 31)))]
    check(spark, cases, *dates.quarter_range(x()), kind="date")
    assert all(dates.quarter_of(day) == expected for day, expected in cases)
    assert dates.quarter_of(d(2024, 2, 29)) == (d(2024, 1, 1), d(2024, 3, 31))


@pytest.mark.parametrize("iso_year", [False, True])
@pytest.mark.parametrize("quarter", [dt.date(y, m, 1) for y in (2020, 2024, 2026, 2027) for m in (1, 4, 7, 10)])
def test_whole_week_ranges(quarter, iso_year):
    """Brute force: exactly the days that share a key with a day of the window."""
    start, end = dates.quarter_of(quarter)
    near = [dt.date(quarter.year - 1, 1, 1) + dt.timedelta(days=i) for i in range(3 * 366)]
    keys = {dates.week_of(d, iso_year) for d in near if start <= d <= end}
    expected = {d for d in near if dates.week_of(d, iso_year) in keys}
    ranges = dates.whole_week_ranges(start, end, iso_year)
    assert {d for d in near if any(a <= d <= b for a, b in ranges)} == expected


def test_decimal_comma_rounds_like_printf(spark):
    values = [0.5, 0.0078125, 0.0015625, 0.0000005, 1234567.5, -0.25, 2 / 3, 0.0234375]
    check(spark, [(v, f"{v:.6f}".replace(".", ",")) for v in values] + [(None, ""), (float("nan"), "")],
          numbers.decimal_comma(x()), kind="double")


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 2)], "n long, d long")
    got = df.select(numbers.safe_ratio(F.col("n"), F.col("d"))).collect()
    assert [r[0] for r in got] == [0.25, 0.0, 0.0]

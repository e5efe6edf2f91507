"""Golden values for blank rules, dates and text."""

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tallygrid.functions import blank, dates, text

NUMBERS = [(None, None), (None, 2.0), (3.0, None), (3.0, 2.0), (3.0, 0.0), (0.0, 0.0)]


def numbers(spark):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(NUMBERS)], "i int, a double, b double")


@pytest.mark.parametrize(
    ("make", "wanted"),
    [
        (lambda a, b: blank.add(a, b), [None, 2, 3, 5, 3, 0]),
        (lambda a, b: blank.sub(a, b), [None, -2, 3, 1, 3, 0]),
        (lambda a, b: blank.mul(a, b), [None, None, None, 6, 0, 0]),
        (lambda a, b: blank.safe_div(a, b), [None, None, None, 1.5, None, None]),
        (lambda a, b: blank.safe_div(a, b, 0), [0, None, 0, 1.5, 0, 0]),
        (lambda a, b: blank.pct_change(a, b), [None, -100, None, 50, None, None]),
        (lambda a, b: blank.first_non_blank(a, b), [None, 2, 3, 3, 3, 0]),
        (lambda a, b: blank.margin_share(a, b), [None, None, 1, 1 / 3, 1, None]),
    ],
)
def test_blank_arithmetic(spark, make, wanted):
    rows = numbers(spark).select("i", make(F.col("a"), F.col("b")).alias("x")).orderBy("i").collect()
    assert [r.x for r in rows] == pytest.approx(wanted)


def test_blank_tests(spark):
    df = spark.createDataFrame([(None,), (0,), (7,)], "v int")
    rows = df.select(blank.equals_blank_as_zero(F.col("v"), 0), blank.not_blank_or_zero(F.col("v")), blank.not_in(F.col("v"), [7])).collect()
    assert [tuple(r) for r in rows] == [(True, False, True), (True, False, True), (False, True, False)]


def one(spark, day, column):
    return spark.createDataFrame([(dt.date.fromisoformat(day),)], "d date").select(column(F.col("d"))).first()[0]


@pytest.mark.parametrize(
    ("day", "column", "wanted"),
    [
        ("2024-12-30", dates.iso_week, 1),
        ("2024-12-30", dates.iso_year, 2025),
        ("2024-02-29", lambda d: dates.end_of_month(d, 12), dt.date(2025, 2, 28)),
        ("2024-04-30", dates.fiscal_year, 2024),
        ("2024-05-01", dates.fiscal_year, 2025),
        ("2024-04-30", dates.fiscal_month, 12),
        ("2024-05-01", dates.fiscal_month, 1),
        ("2024-01-07", dates.weekday_sunday, 1),
        ("2024-01-07", dates.weekday_monday, 7),
        ("2023-01-01", dates.year_week_text, "202301"),
        ("2023-01-08", dates.year_week_text, "202302"),
        ("2024-01-13", lambda d: dates.weeks_between(d, F.lit(dt.date(2024, 1, 14))), 1),
        ("2024-03-01", lambda d: dates.rel_month(d, dt.date(2023, 12, 31)), 3),
        ("2024-03-05", dates.month_label, "mrt 24"),
        ("2024-01-10", dates.iteration, "1-2"),
    ],
)
def test_dates(spark, day, column, wanted):
    assert one(spark, day, column) == wanted


def test_bad_text_is_blank(spark):
    df = spark.createDataFrame([("31-02-2024",), ("x",), (None,), ("15-03-2024",)], "t string")
    rows = df.select(dates.parse_date(F.col("t"), "dd-MM-yyyy").alias("d"), dates.term_month(F.col("t")).alias("m")).collect()
    assert [r.d for r in rows] == [None, None, None, dt.date(2024, 3, 15)]
    assert [r.m for r in rows] == [dt.date(2024, 2, 1), None, None, dt.date(2024, 3, 1)]


@settings(max_examples=1, deadline=None)
@given(st.integers(0, 3000))
def test_iso_week_matches_python(spark, offset):
    first = dt.date(2019, 1, 1) + dt.timedelta(days=offset)
    days = [first + dt.timedelta(days=n) for n in range(800)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = {r[0]: (r[1], r[2]) for r in df.select("d", dates.iso_year(F.col("d")), dates.iso_week(F.col("d"))).collect()}
    assert got == {d: tuple(d.isocalendar())[:2] for d in days}


def test_text(spark):
    df = spark.createDataFrame([("Sprint 12  Sprint x",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(text.strip_word(F.col("t"), "Sprint")).collect()] == ["12 x", "", None]
    assert [r[0] for r in df.select(text.same_text(F.col("t"), "sprint 12  sprint X")).collect()] == [True, False, None]
    assert [r[0] for r in df.select(text.joined(F.lit("a"), F.lit(None), F.lit(1))).collect()] == ["a1"] * 3


def test_date_table_has_one_row_per_day(spark):
    table = dates.date_table(spark, "2023-12-30", "2024-03-01", "2024-02-29")
    assert table.count() == 63 and table.select("DatumKey").distinct().count() == 63
    today = table.filter("IsVandaag = 1").first()
    assert (today.Datum, today.LaatsteDagVanMaand, today.MaandNrRelatief) == (dt.date(2024, 2, 29), dt.date(2024, 2, 29), 0)

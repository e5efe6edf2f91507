"""Date functions and the date dimension.

Nothing here reads the clock: "today" is always the argument ``as_of``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# --- fixed values -----------------------------------------------------------
# Dutch month and day names, so labels do not depend on the JVM locale.
MONTHS = [
    "januari", "februari", "maart", "april", "mei", "juni",
    "juli", "augustus", "september", "oktober", "november", "december",
]
MONTHS_SHORT = ["jan", "feb", "mrt", "apr", "mei", "jun", "jul", "aug", "sep", "okt", "nov", "dec"]
DAYS = ["zondag", "maandag", "dinsdag", "woensdag", "donderdag", "vrijdag", "zaterdag"]
DAYS_SHORT = ["zo", "ma", "di", "wo", "do", "vr", "za"]
FISCAL_START = 5
# ---------------------------------------------------------------------------


def to_day(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def label(position: Column, names: list[str]) -> Column:
    """The n-th name of a fixed list, counting from 1."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), position.cast("int"))


def day_of(year: Column, month: Column, day: Column) -> Column:
    """Date from parts; impossible parts give an empty value."""
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day), "yyyy-MM-dd")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def end_of_month(d: Column, months: int = 0) -> Column:
    return F.last_day(F.add_months(d, months))


def iso_week(d: Column) -> Column:
    return F.weekofyear(d)


def iso_year(d: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), d)


def weekday_sunday(d: Column) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(d)


def weekday_monday(d: Column) -> Column:
    """1 = Monday … 7 = Sunday."""
    return F.weekday(d) + 1


def week_from_january_first(d: Column, first_day: str = "sunday") -> Column:
    """Week number where week 1 holds 1 January; the first weekday is a choice of culture."""
    first = F.trunc(d, "year")
    lead = F.dayofweek(first) - 1 if first_day == "sunday" else F.weekday(first)
    return F.floor((F.dayofyear(d) + lead - 1) / 7).cast("int") + 1


def year_week_text(d: Column) -> Column:
    return F.concat(F.year(d).cast("string"), F.lpad(week_from_january_first(d).cast("string"), 2, "0"))


def parse_date(c: Column, fmt: str = "MM/dd/yyyy") -> Column:
    """Text to date; text that does not fit gives an empty value."""
    return F.try_to_date(c, fmt)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def weeks_between(start: Column, end: Column) -> Column:
    """Number of Saturday-to-Sunday boundaries crossed from start to end."""
    sunday = lambda d: F.date_sub(d, F.dayofweek(d) - 1)
    return (F.datediff(sunday(end), sunday(start)) / 7).cast("int")


def date_number(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("long")


def month_label(d: Column) -> Column:
    """``MMM yy`` with fixed month names."""
    return F.concat(label(F.month(d), MONTHS_SHORT), F.lit(" "), F.date_format(d, "yy"))


def short_date(d: Column) -> Column:
    return F.date_format(d, "dd-MM-yy")


def term_month(c: Column) -> Column:
    """First day of the month written in ``dd-MM-yyyy`` text, cut out by position."""
    month = F.substring(c, 4, 2).try_cast("int")
    year = F.right(c, F.lit(4)).try_cast("int")
    return day_of(year, month, F.lit(1))


def rel_month(d: Column, as_of: dt.date) -> Column:
    """Whole months from the month of ``as_of``; 0 is the current month."""
    return (F.year(d) * 12 + F.month(d)) - F.lit(as_of.year * 12 + as_of.month)


def fiscal_year(d: Column, start_month: int = FISCAL_START) -> Column:
    return F.year(F.add_months(d, 13 - start_month))


def fiscal_month(d: Column, start_month: int = FISCAL_START) -> Column:
    return F.month(F.add_months(d, 13 - start_month))


def iteration_start(d: Column) -> Column:
    """First (odd) ISO week of the two-week iteration holding the date."""
    week = F.weekofyear(d)
    return week - F.when(week % 2 == 0, F.lit(1)).otherwise(F.lit(0))


def iteration(d: Column) -> Column:
    start = iteration_start(d)
    return F.concat_ws("-", start.cast("string"), (start + 1).cast("string"))


def in_period(c: Column, unit: str, as_of: dt.date) -> Column:
    """The value lies in the same year / quarter / month / week as ``as_of``."""
    return F.trunc(c, unit) == F.trunc(F.lit(as_of), unit)


def calendar(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per day from start to end, both included."""
    first, last = to_day(start), to_day(end)
    days = (last - first).days + 1
    return spark.range(0, days, 1, 1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("Datum")
    )


def calendar_for(df: DataFrame, column: str) -> DataFrame:
    """Calendar of whole years covering a date column, as generated per date column."""
    span = df.agg(
        F.trunc(F.min(column), "year").alias("a"),
        F.date_sub(F.add_months(F.trunc(F.max(column), "year"), 12), 1).alias("b"),
    )
    return span.select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("Datum")
    )


def whole_numbers(df: DataFrame) -> DataFrame:
    """Integer columns as ``bigint``, the type that models declare."""
    return df.withColumns({c: F.col(f"`{c}`").cast("long") for c, t in df.dtypes if t == "int"})


def calendar_levels(df: DataFrame, column: str = "Datum") -> DataFrame:
    """Year / quarter / month / day levels of a generated calendar."""
    d = F.col(column)
    levels = df.select(
        "*",
        F.year(d).alias("Year"),
        F.month(d).alias("MonthNo"),
        label(F.month(d), MONTHS).alias("Month"),
        F.quarter(d).alias("QuarterNo"),
        F.concat(F.lit("Qtr "), F.quarter(d).cast("string")).alias("Quarter"),
        F.dayofmonth(d).alias("Day"),
    )
    return whole_numbers(levels)


def date_table(
    spark: SparkSession, start: dt.date | str, end: dt.date | str, as_of: dt.date | str
) -> DataFrame:
    """The date dimension between two days."""
    return date_attributes(calendar(spark, start, end), as_of)


def date_attributes(days: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Keys, labels, bounds and flags of every day of a calendar."""
    today = to_day(as_of)
    now = F.lit(today)
    d = F.col("Datum")
    week = F.weekofyear(d)
    this_week = F.weekofyear(now)
    year, month, day = F.year(d), F.month(d), F.dayofmonth(d)
    flag = lambda p: F.when(p, F.lit(1)).otherwise(F.lit(0))
    before_this_day = (month == F.month(now)) & (day < F.dayofmonth(now))
    start_week = iteration_start(d)
    span = lambda a: F.concat_ws("-", a.cast("string"), (a + 1).cast("string"))
    fiscal = fiscal_year(d)
    text = lambda c: c.cast("string")
    last_week = F.date_sub(now, 7)
    attributes = days.select(
        d,
        date_number(d).alias("DatumKey"),
        day.alias("Dag"),
        F.dayofweek(d).alias("Weekdag"),
        label(F.dayofweek(d), DAYS).alias("WeekDagNaam"),
        label(F.dayofweek(d), DAYS_SHORT).alias("WeekDagNaamKort"),
        flag(F.weekday(d) >= 5).alias("IsWeekend"),
        week_from_january_first(d).alias("WeekNummer"),
        week.alias("ISOWeekNummer"),
        iso_year(d).alias("ISOJaar"),
        month.alias("MaandNummer"),
        (F.lit(13) - month).alias("MaandNummerOmgekeerd"),
        label(month, MONTHS).alias("MaandNaam"),
        label(month, MONTHS_SHORT).alias("MaandNaamKort"),
        F.quarter(d).alias("KwartaalNummer"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("KwartaalNaam"),
        year.alias("Jaar"),
        F.date_format(d, "MMyyyy").alias("MMYYYY"),
        (year * 100 + month).alias("JaarMaand"),
        (year * 100 + week).alias("JaarWeek"),
        F.concat_ws("-", year.cast("string"), F.concat(F.lit("w"), week.cast("string"))).alias(
            "JaarWeekNaam"
        ),
        F.concat(F.lit("w"), text(week), F.lit("-"), F.date_format(d, "yy")).alias("JaarWeekNaamKort"),
        F.concat(F.lit("w"), text(week)).alias("WeekNaamKort"),
        F.concat(F.lit("week "), text(week)).alias("WeekNaamLang"),
        this_week.alias("HuidigWeekNr"),
        # the calendar year with the ISO week, as for every day's own label
        F.concat(text(F.year(last_week)), F.lit("-w"), text(F.weekofyear(last_week))).alias("VorigeWeekLang"),
        month_label(d).alias("MaandJaar"),
        F.trunc(d, "month").alias("EersteDagVanMaand"),
        F.last_day(d).alias("LaatsteDagVanMaand"),
        F.trunc(d, "quarter").alias("EersteDagVanKwartaal"),
        F.date_sub(F.add_months(F.trunc(d, "quarter"), 3), 1).alias("LaatsteDagVanKwartaal"),
        F.trunc(d, "year").alias("EersteDagVanJaar"),
        F.date_sub(F.add_months(F.trunc(d, "year"), 12), 1).alias("LaatsteDagVanJaar"),
        F.add_months(F.trunc(d, "month"), 1).alias("EersteDagVanVolgendeMaand"),
        F.add_months(F.trunc(d, "year"), 12).alias("EersteDagVanVolgendJaar"),
        rel_month(d, today).alias("MaandNrRelatief"),
        weeks_between(d, now).alias("RelatiefWeekNr"),
        F.datediff(now, d).alias("RelatiefDagNr"),
        # 1 … 6 = after today's weekday; larger numbers = up to today's weekday
        F.when(F.dayofweek(d) <= F.dayofweek(now), F.dayofweek(d) + F.dayofweek(now) + 1)
        .otherwise(F.dayofweek(d) - F.dayofweek(now))
        .alias("WeekdagNrRelatief"),
        flag(week < this_week).alias("IsYTDweek"),
        flag((month < F.month(now)) | before_this_day).alias("IsYTD"),
        flag((fiscal_month(d) < fiscal_month(now)) | before_this_day).alias("IsFYTD"),
        flag(d > now).alias("IsToekomst"),
        flag(d < now).alias("IsVerleden"),
        flag(d == now).alias("IsVandaag"),
        flag(year == F.year(now)).alias("IsHuidigJaar"),
        flag(month == F.month(now)).alias("IsHuidigeMaand"),
        flag(week == this_week).alias("IsHuidigeWeek"),
        flag(week == this_week - 1).alias("IsVorigeWeek"),
        fiscal.alias("BoekjaarNr"),
        F.concat_ws("-", (fiscal - 1).cast("string"), fiscal.cast("string")).alias("BoekjaarNaam"),
        fiscal_month(d).alias("BoekmaandNr"),
        label(month, MONTHS_SHORT).alias("BoekmaandNaamKort"),
        label(month, MONTHS).alias("BoekmaandNaamLang"),
        span(start_week).alias("Iteratie"),
        F.concat_ws("/", year.cast("string"), span(start_week)).alias("JaarIteratie"),
        start_week.alias("IteratieStartWeek"),
        (start_week + 1).alias("IteratieEindWeek"),
        span(start_week + 2).alias("VolgendeIteratie"),
        span(start_week - 2).alias("VorigeIteratie"),
        flag(this_week.between(start_week, start_week + 1)).alias("IsHuidigeIteratie"),
    )
    return whole_numbers(attributes)

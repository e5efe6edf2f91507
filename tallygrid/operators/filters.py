"""Row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallygrid.functions import blank
from tallygrid.functions.dates import in_period, to_day


def where(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.filter(predicate)


def where_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(F.col(column).isin(list(values)))


def where_not_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Negated list that keeps rows with an empty value."""
    return df.filter(blank.not_in(F.col(column), values))


def where_blank(df: DataFrame, column: str, is_blank: bool = True) -> DataFrame:
    return df.filter(F.col(column).isNull() if is_blank else F.col(column).isNotNull())


def day_range(column: str, start: dt.date, end: dt.date) -> Column:
    """start <= day <= end on a raw date or timestamp column, so it reaches the scan."""
    after = F.lit(end + dt.timedelta(days=1))
    return (F.col(column) >= F.lit(start)) & (F.col(column) < after)


def on_day(df: DataFrame, column: str, day: dt.date | str) -> DataFrame:
    return df.filter(day_range(column, to_day(day), to_day(day)))


def since(df: DataFrame, column: str, day: dt.date | str) -> DataFrame:
    return df.filter(F.col(column) >= F.lit(to_day(day)))


def newer_than(df: DataFrame, column: str, highest) -> DataFrame:
    """Rows above the highest value already loaded; everything when nothing is."""
    return df if highest is None else df.filter(F.col(column) > F.lit(highest))


def exclude(df: DataFrame, column: str, values: Sequence, *extra: Column) -> DataFrame:
    """Leave out named members, optionally only where a further test holds."""
    test = F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    for more in extra:
        test = test & F.coalesce(more, F.lit(False))
    return df.filter(~test)


def live_rows(df: DataFrame, score: str, deleted: str) -> DataFrame:
    return df.filter(F.col(score).isNotNull() & (F.col(deleted).cast("int") == 0))


def within_period(df: DataFrame, column: str, unit: str, as_of: dt.date | str) -> DataFrame:
    """Relative date filter, such as "in the current year"."""
    day = to_day(as_of)
    if unit == "year":
        return df.filter(day_range(column, dt.date(day.year, 1, 1), dt.date(day.year, 12, 31)))
    return df.filter(in_period(F.col(column), unit, day))


def failed_loads(df: DataFrame, status: str = "Status") -> DataFrame:
    return df.filter(F.col(status) == "Failed")


def any_failed(df: DataFrame, status: str = "Status") -> bool:
    return not failed_loads(df, status).isEmpty()

"""Period transformers: functions from metric to metric.

"Today" is always the ``as_of`` of a :class:`Period`; a chosen year or month
replaces it, as a slicer would.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from tallygrid.functions.dates import to_day
from tallygrid.plans import metric as m

DATE = "DimDatum"


@dataclass(frozen=True)
class Period:
    """A reporting period: explicit ``as_of`` plus an optional year and month."""

    as_of: dt.date
    year: int | None = None
    month: int | None = None
    end: dt.date | None = None  # last day of the selection, when there is one

    @staticmethod
    def at(as_of: dt.date | str, year: int | None = None, month: int | None = None, end=None) -> "Period":
        return Period(to_day(as_of), year, month, to_day(end) if end else None)

    @property
    def current_year(self) -> int:
        return self.as_of.year if self.year is None else self.year

    @property
    def current_month(self) -> int:
        return self.as_of.month if self.month is None else self.month

    @property
    def rel_month(self) -> int:
        """Relative number of the chosen month, counted from the month of ``as_of``."""
        return (self.current_year * 12 + self.current_month) - (self.as_of.year * 12 + self.as_of.month)

    @property
    def max_date(self) -> dt.date:
        """Yesterday, or the end of the selection when that is earlier."""
        yesterday = self.as_of - dt.timedelta(days=1)
        return yesterday if self.end is None else min(self.end, yesterday)


def to_month(as_of: dt.date, relative: int) -> dt.date:
    """First day of the month with this relative number."""
    n = as_of.year * 12 + as_of.month - 1 + relative
    return dt.date(n // 12, n % 12 + 1, 1)


def _months(metric: m.Metric, period: "Period", low: int, high: int, date: str) -> m.Metric:
    """Window of relative months, written as a date range so that it reaches the scan."""
    first = to_month(period.as_of, low)
    last = to_month(period.as_of, high + 1) - dt.timedelta(days=1)
    return m.where(metric, m.between(f"{date}.Datum", first, last))


def last_12m(metric: m.Metric, period: Period, date: str = DATE) -> m.Metric:
    return _months(metric, period, period.rel_month - 11, period.rel_month, date)


def previous_12m(metric: m.Metric, period: Period, date: str = DATE) -> m.Metric:
    """The last-12-month window, each month showing the value of a year before."""
    return _months(m.shifted(metric, 12), period, period.rel_month - 11, period.rel_month, date)


def next_12m(
    metric: m.Metric, period: Period, include_current: bool = True, half_open: bool = False, date: str = DATE
) -> m.Metric:
    low = period.rel_month if include_current else period.rel_month + 1
    high = period.rel_month + (11 if half_open else 12)
    return _months(metric, period, low, high, date)


def last_year(metric: m.Metric) -> m.Metric:
    """Same period last year: 29 February shows on 28 February."""
    return m.shifted(metric, 12)


def running_ytd(metric: m.Metric, last: dt.date | None = None, date: str = DATE) -> m.Metric:
    """Year to date by grouping: each group of dates reads its year from 1 January to the group's last day."""
    return m.windowed(metric, "year_to_date", date, last)


def month_before(metric: m.Metric, last: dt.date | None = None, date: str = DATE) -> m.Metric:
    """Previous month by grouping: each group of dates reads the calendar month before that of its last day."""
    return m.windowed(metric, "month_before", date, last)


def in_dates(metric: m.Metric, start: dt.date, end: dt.date, date: str = DATE) -> m.Metric:
    """Replace the date filter by a fixed range."""
    return m.where(m.ignoring(metric, date), m.between(f"{date}.Datum", start, end))


def previous_month(metric: m.Metric, day: dt.date, date: str = DATE) -> m.Metric:
    last = day.replace(day=1) - dt.timedelta(days=1)
    return in_dates(metric, last.replace(day=1), last, date)


def year_to_date(metric: m.Metric, as_of: dt.date, date: str = DATE) -> m.Metric:
    return in_dates(metric, as_of.replace(month=1, day=1), as_of, date)


def ytd(metric: m.Metric, period: Period, date: str = DATE) -> m.Metric:
    """Chosen year up to the earlier of the selection's end and yesterday."""
    first = dt.date(period.current_year, 1, 1)
    last = min(dt.date(period.current_year, 12, 31), period.max_date)
    return in_dates(metric, first, last, date)


def week_start(as_of: dt.date) -> dt.date:
    """The day before Monday of the week of ``as_of``: the Sunday."""
    return as_of - dt.timedelta(days=as_of.isoweekday())


def in_days(metric: m.Metric, start: dt.date, end: dt.date, ref: str, *ignore: str) -> m.Metric:
    """Days of a fact's own date column, dropping other filters on the named tables."""
    return m.where(m.ignoring(metric, *ignore), m.between(ref, start, end))


def week_to_date(metric: m.Metric, as_of: dt.date, ref: str, *ignore: str) -> m.Metric:
    return in_days(metric, week_start(as_of), as_of, ref, *ignore)


def last_week(metric: m.Metric, as_of: dt.date, ref: str, *ignore: str) -> m.Metric:
    start = week_start(as_of) - dt.timedelta(days=7)
    return in_days(metric, start, start + dt.timedelta(days=6), ref, *ignore)


def on_day(metric: m.Metric, day: dt.date, ref: str, *ignore: str) -> m.Metric:
    return in_days(metric, day, day, ref, *ignore)


def due_to_date(metric: m.Metric, as_of: dt.date, ref: str) -> m.Metric:
    return m.where(metric, m.compare(ref, "<=", as_of))


def actual_plus_forecast(actual: m.Metric, forecast: m.Metric, as_of: dt.date, week: str) -> m.Metric:
    """Actuals before this week plus forecast from this week on.

    Compares week numbers only, whatever the year, as the definition does.
    """
    now = as_of.isocalendar().week
    return m.plus(
        m.where(actual, m.compare(week, "<", now)), m.where(forecast, m.compare(week, ">=", now))
    )


# the named transformers of the period menu
TRANSFORMERS = {
    "Komende 12 maanden": next_12m,
    "Laatste 12 maanden": last_12m,
    "TESTKomende 12 maanden": lambda x, p: next_12m(x, p, half_open=True),
    "Voorgaande 12 maanden": previous_12m,
}


def apply(transform: str, metric: m.Metric, period: Period) -> m.Metric:
    return TRANSFORMERS[transform](metric, period)


def run_dates(as_of: dt.date, run_date: str | None = None, days_back: int = 367) -> list[dt.date]:
    """Days to load, ending at the run date (by default the day before ``as_of``)."""
    last = to_day(run_date) if run_date and run_date.strip() else as_of - dt.timedelta(days=1)
    return [last - dt.timedelta(days=n) for n in range(days_back - 1, -1, -1)]



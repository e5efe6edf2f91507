"""Metric objects.

A metric is data, not a result: a base aggregate of one fact (with its own
predicates, role choices and ignored dimensions) or a combination of other
metrics. ``plans.evaluate`` turns metrics into one DataFrame plan.

References are written ``"Table.Column"``.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any, Union

from pyspark.sql import Column, functions as F

from tallygrid.functions import blank


@dataclass(frozen=True)
class Pred:
    """A predicate over named columns; ``build`` gets one Column per reference.

    ``text`` identifies the predicate, so that equal predicates compare equal.
    """

    refs: tuple[str, ...]
    text: str
    build: Callable[..., Column] = dataclasses.field(compare=False, repr=False)
    # inclusive date bounds, when the predicate is a plain date range
    days: tuple[dt.date | None, dt.date | None] | None = None

    def tables(self) -> set[str]:
        return {r.split(".", 1)[0] for r in self.refs}


def _pred(ref: str, text: str, build: Callable[[Column], Column]) -> Pred:
    return Pred((ref,), f"{ref} {text}", build)


def eq(ref: str, value: Any) -> Pred:
    """Equality; 0 also matches an empty value, text ignores case."""
    if isinstance(value, bool):
        return _pred(ref, f"= {value}", lambda c: F.coalesce(c.cast("boolean"), F.lit(False)) == value)
    if isinstance(value, (int, float)) and value == 0:
        return _pred(ref, "= 0", lambda c: F.coalesce(c, F.lit(0)) == 0)
    if isinstance(value, str):
        return _pred(ref, f"= '{value}'", lambda c: F.lower(c) == value.lower())
    return _pred(ref, f"= {value!r}", lambda c: c == F.lit(value))


def ne(ref: str, value: Any) -> Pred:
    """Inequality; an empty value differs from everything but 0."""
    if isinstance(value, (int, float)) and value == 0:
        return not_zero(ref)
    return _pred(ref, f"<> {value!r}", lambda c: F.coalesce(c != F.lit(value), F.lit(True)))


def not_zero(ref: str) -> Pred:
    return _pred(ref, "<> blank", blank.not_blank_or_zero)


def is_in(ref: str, values: Sequence[str]) -> Pred:
    low = [v.lower() for v in values]
    return _pred(ref, f"in {sorted(low)}", lambda c: F.lower(c).isin(low))


def not_in(ref: str, values: Sequence[str]) -> Pred:
    low = [v.lower() for v in values]
    return _pred(ref, f"not in {sorted(low)}", lambda c: blank.not_in(F.lower(c), low))


def is_blank(ref: str) -> Pred:
    return _pred(ref, "is blank", lambda c: c.isNull())


def not_blank(ref: str) -> Pred:
    return _pred(ref, "is not blank", lambda c: c.isNotNull())


def compare(ref: str, op: str, value: Any) -> Pred:
    tests = {
        "<": lambda c: c < F.lit(value),
        "<=": lambda c: c <= F.lit(value),
        ">": lambda c: c > F.lit(value),
        ">=": lambda c: c >= F.lit(value),
    }
    days = None
    if isinstance(value, dt.date):
        day = dt.timedelta(days=1)
        days = {
            "<": (None, value - day),
            "<=": (None, value),
            ">": (value + day, None),
            ">=": (value, None),
        }[op]
    return dataclasses.replace(_pred(ref, f"{op} {value!r}", tests[op]), days=days)


def between(ref: str, low: Any, high: Any) -> Pred:
    pred = _pred(ref, f"between {low!r} and {high!r}", lambda c: c.between(F.lit(low), F.lit(high)))
    return dataclasses.replace(pred, days=(low, high)) if isinstance(low, dt.date) else pred


def year_is(ref: str, year: int) -> Pred:
    return _pred(ref, f"year = {year}", lambda c: F.year(c) == year)


def any_of(*preds: Pred) -> Pred:
    refs = tuple(r for p in preds for r in p.refs)

    def build(*columns: Column) -> Column:
        at, result = 0, None
        for p in preds:
            part = F.coalesce(p.build(*columns[at : at + len(p.refs)]), F.lit(False))
            at += len(p.refs)
            result = part if result is None else result | part
        return result

    return Pred(refs, "(" + " or ".join(p.text for p in preds) + ")", build)


# kinds of base aggregate
KINDS = ("sum", "count", "rows", "distinct", "avg", "max", "min", "sum_of_max")


@dataclass(frozen=True)
class Base:
    """One aggregate of one table.

    ``column``  reference on the table itself (or on a dimension of it);
    ``times``   optional second factor, looked up on a dimension;
    ``each``    inner grouping of ``sum_of_max``;
    ``days``    count the days of a timestamp rather than its values;
    ``where``   conjunction of predicates, each on the table or on dimensions;
    ``via``     (from, to) relationships to use instead of the active ones;
    ``without`` dimensions whose relationship is switched off;
    ``ignore``  dimensions whose outer filters and grouping do not apply;
    ``keep``    exceptions to ``ignore``: references that still apply;
    ``over``    references whose grouping is dropped while their filters stay;
    ``shift``   months by which fact dates move forward before the date join;
    ``window``  (name, date table, last day): every group of dates reads the days of this window
                around its last day, whatever dates are selected otherwise; where nothing
                selects dates, around the last day named here;
    ``treat``   (fact column, dimension column): the dimension's visible values restrict
                the fact by this column, with or without a relationship.
    """

    table: str
    kind: str
    column: str | None = None
    times: str | None = None
    each: str | None = None
    days: bool = False
    where: tuple[Pred, ...] = ()
    via: tuple[tuple[str, str], ...] = ()
    without: frozenset[str] = frozenset()
    ignore: frozenset[str] = frozenset()
    keep: frozenset[str] = frozenset()
    over: frozenset[str] = frozenset()
    shift: int = 0
    window: tuple[str, str, dt.date | None] | None = None
    treat: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Derived:
    """A combination of other metrics, computed after aggregation."""

    combine: Callable[..., Column] = dataclasses.field(repr=False)
    parts: tuple["Metric", ...] = ()


Metric = Union[Base, Derived]


def sum_(ref: str, *where: Pred) -> Base:
    return Base(ref.split(".")[0], "sum", ref, where=where)


def count_(ref: str, *where: Pred) -> Base:
    return Base(ref.split(".")[0], "count", ref, where=where)


def rows(table: str, *where: Pred) -> Base:
    return Base(table, "rows", where=where)


def distinct_(ref: str, *where: Pred) -> Base:
    return Base(ref.split(".")[0], "distinct", ref, where=where)


def distinct_days(ref: str, *where: Pred) -> Base:
    """Number of different days in a date or timestamp column."""
    return Base(ref.split(".")[0], "distinct", ref, days=True, where=where)


def avg_(ref: str, *where: Pred) -> Base:
    return Base(ref.split(".")[0], "avg", ref, where=where)


def max_(ref: str, *where: Pred) -> Base:
    return Base(ref.split(".")[0], "max", ref, where=where)


def min_(ref: str, *where: Pred) -> Base:
    return Base(ref.split(".")[0], "min", ref, where=where)


def sum_expr(ref: str, times: str) -> Base:
    """Sum over rows of own column × a dimension's column (row context)."""
    return Base(ref.split(".")[0], "sum", ref, times=times)


def sum_of_max(ref: str, each: str, *where: Pred) -> Base:
    """Highest value per member of ``each``, added up."""
    return Base(ref.split(".")[0], "sum_of_max", ref, each=each, where=where)


def constant(value: float) -> Derived:
    return Derived(lambda: F.lit(value), ())


def derived(combine: Callable[..., Column], *parts: Metric) -> Derived:
    return Derived(combine, parts)


def ratio(a: Metric, b: Metric, alternate: float | None = None) -> Derived:
    return Derived(lambda x, y: blank.safe_div(x, y, alternate), (a, b))


def plus(a: Metric, b: Metric) -> Derived:
    return Derived(blank.add, (a, b))


def minus(a: Metric, b: Metric) -> Derived:
    return Derived(blank.sub, (a, b))


def product(a: Metric, b: Metric) -> Derived:
    return Derived(blank.mul, (a, b))


def rewrite(metric: Metric, change: Callable[[Base], Base]) -> Metric:
    """Apply a change to every base aggregate below a metric."""
    if isinstance(metric, Base):
        return change(metric)
    return Derived(metric.combine, tuple(rewrite(p, change) for p in metric.parts))


def where(metric: Metric, *preds: Pred) -> Metric:
    """Add predicates; they narrow the current filters."""
    return rewrite(metric, lambda b: dataclasses.replace(b, where=b.where + preds))


def via(metric: Metric, source: str, target: str) -> Metric:
    """Use an alternate (role-playing) relationship for this metric."""
    return rewrite(metric, lambda b: dataclasses.replace(b, via=b.via + ((source, target),)))


def without(metric: Metric, dim: str) -> Metric:
    """Switch the relationship to a dimension off."""
    return rewrite(metric, lambda b: dataclasses.replace(b, without=b.without | {dim}))


def ignoring(metric: Metric, *dims: str) -> Metric:
    """Ignore outer filters and grouping on these dimensions."""
    return rewrite(metric, lambda b: dataclasses.replace(b, ignore=b.ignore | frozenset(dims)))


def keep_only(metric: Metric, table: str, *refs: str) -> Metric:
    """Ignore filters and grouping on a dimension, except on the named columns."""
    return rewrite(
        metric,
        lambda b: dataclasses.replace(
            b, ignore=b.ignore | {table}, keep=b.keep | frozenset(refs)
        ),
    )


def over_selection(metric: Metric, *refs: str) -> Metric:
    """Ignore the grouping on these columns but keep the outer selection."""
    return rewrite(metric, lambda b: dataclasses.replace(b, over=b.over | frozenset(refs)))


def shifted(metric: Metric, months: int) -> Metric:
    """Show each value ``months`` later than its own date."""
    return rewrite(metric, lambda b: dataclasses.replace(b, shift=b.shift + months))


def windowed(metric: Metric, window: str, date: str, last: dt.date | None = None) -> Metric:
    """Read, in every group of dates, the days of a window around the group's last day (``last`` where nothing selects dates).

    Where a metric replaces the filter on the date table itself, that inner choice stays.
    """
    return rewrite(metric, lambda b: b if date in b.ignore or b.window else dataclasses.replace(b, window=(window, date, last)))


def treat_as(metric: Metric, values: str, *columns: str) -> Metric:
    """Treat the visible values of a dimension column as values of the fact columns (of whichever fact is aggregated)."""
    by_table = {c.split(".", 1)[0]: c for c in columns}
    return rewrite(metric, lambda b: dataclasses.replace(b, treat=(*b.treat, (by_table[b.table], values))) if b.table in by_table else b)


def bases(metric: Metric) -> list[Base]:
    if isinstance(metric, Base):
        return [metric]
    return [b for p in metric.parts for b in bases(p)]


def switch_metric(option: str, name: str, choices: dict[str, dict[str, Metric]], default: Metric) -> Metric:
    """Pick a metric by option and name; anything not listed stays as it is."""
    return choices.get(option, {}).get(name, default)

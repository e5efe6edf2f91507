"""Blank-aware arithmetic: how an empty value behaves in metrics.

An empty value acts as zero in a sum or difference, but a sum of two empty
values stays empty; a product with an empty value is empty; a division by zero
or by an empty value is empty (or a given alternate) and never raises.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F


def safe_div(a: Column, b: Column, alternate: float | None = None) -> Column:
    # an empty numerator over a usable denominator stays empty
    bad = b.isNull() | (b == 0)
    quotient = F.try_divide(a, b)
    if alternate is None:
        return quotient
    return F.when(bad, F.lit(float(alternate))).otherwise(quotient)


def add(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))


def sub(a: Column, b: Column) -> Column:
    return F.when(a.isNotNull() | b.isNotNull(), F.coalesce(a, F.lit(0)) - F.coalesce(b, F.lit(0)))


def mul(a: Column, b: Column) -> Column:
    return a * b


def first_non_blank(*columns: Column) -> Column:
    return F.coalesce(*columns)


def iff(condition: Column, then: Column, otherwise: Column | None = None) -> Column:
    branch = F.when(condition, then)
    return branch if otherwise is None else branch.otherwise(otherwise)


def equals_blank_as_zero(c: Column, value: float) -> Column:
    """``c = value`` where an empty value equals zero."""
    return F.coalesce(c, F.lit(0)) == F.lit(value)


def not_blank_or_zero(c: Column) -> Column:
    """``c <> BLANK()``: drops empty values and zeros."""
    return c.isNotNull() & (c != 0)


def not_in(c: Column, values: Sequence) -> Column:
    """Negated membership that keeps empty values."""
    return ~F.coalesce(c.isin(list(values)), F.lit(False))


def blank_if_zero_rows(n: Column) -> Column:
    """A count of nothing is empty, not 0."""
    return F.nullif(n, F.lit(0))


def constant(value: float) -> Column:
    return F.lit(value)


def derived(combine: Callable[..., Column], *columns: Column) -> Column:
    return combine(*columns)


def trend_sign(difference: Column) -> Column:
    """up / down / flat from a signed difference; empty stays empty."""
    return (
        F.when(difference > 0, F.lit("up"))
        .when(difference < 0, F.lit("down"))
        .when(difference == 0, F.lit("flat"))
    )


def pct_change(current: Column, previous: Column) -> Column:
    return F.when(
        previous.isNotNull() & (previous != 0),
        F.try_divide(sub(current, previous), previous) * 100,
    )


def margin(revenue: Column, cost: Column) -> Column:
    return sub(revenue, cost)


def margin_share(revenue: Column, cost: Column) -> Column:
    return safe_div(sub(revenue, cost), revenue)

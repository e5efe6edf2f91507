"""Aggregations outside the metric evaluator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallygrid.operators.columns import quoted


def concat_values(df: DataFrame, column: str, by: Sequence[str] = (), separator: str = ", ", name: str = "values") -> DataFrame:
    """Distinct values of a group as one text: the caption of a group.

    Values are made distinct before they meet, so only members travel. The text
    is one value and holds all members of its group, as a caption does; use ``members``
    for groups that grow with the data.
    """
    text = F.array_join(F.array_sort(F.collect_list(column)), separator)
    return members(df, column, by).groupBy(*by).agg(text.alias(name))


def members(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values of each group as rows."""
    return df.select(*by, column).distinct()


def sum_of_max(df: DataFrame, by: Sequence[str], each: Sequence[str], column: str, name: str) -> DataFrame:
    """Highest value per inner group, added up per outer group."""
    inner = df.groupBy(*by, *each).agg(F.max(column).alias("_max"))
    return inner.groupBy(*by).agg(F.sum("_max").alias(name))


def distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in columns]).distinct()


def dedupe(df: DataFrame, keys: Sequence[str], prefer: Sequence[str] = ()) -> DataFrame:
    """One row per key. The survivor is the greatest row (by the preferred columns
    first, then all others), so reruns agree.

    The survivor is found by ``max`` of a struct: partial aggregation keeps one
    row per key and task, so a key with very many copies costs no more.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = [*prefer, *[c for c in rest if c not in prefer]]
    if not ordered:
        return df.select(*[quoted(k) for k in keys]).distinct()
    best = F.max(F.struct(*[quoted(c) for c in ordered])).alias("_best")
    return (
        df.groupBy(*[quoted(k) for k in keys])
        .agg(best)
        .select(*[quoted(c) if c in keys else F.col(f"_best.`{c}`").alias(c) for c in df.columns])
    )


def derive_dim(fact: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Dimension from a fact: one row per non-empty key with the greatest attributes."""
    return (
        fact.filter(quoted(key).isNotNull())
        .groupBy(quoted(key))
        .agg(*[F.max(quoted(a)).alias(a) for a in attributes])
    )


def high_water(df: DataFrame, column: str):
    """Highest loaded value, or None for an empty table."""
    return df.agg(F.max(column)).first()[0]


def selected(column: str, default=None) -> Column:
    """The single visible value, else a default (use inside ``agg``)."""
    one = (F.min(column) == F.max(column)) & (F.count(F.lit(1)) == F.count(column))
    return F.when(one, F.max(column)).otherwise(F.lit(default))


def values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def default_agg(df: DataFrame, by: Sequence[str], rules: dict[str, str]) -> DataFrame:
    """Each column's declared default aggregation: sum or count."""
    fold = {"sum": F.sum, "count": F.count}
    return df.groupBy(*by).agg(*[fold[rule](c).alias(c) for c, rule in rules.items()])


def numeric_defaults(df: DataFrame, keys: Sequence[str] = ()) -> dict[str, str]:
    """Sum for amounts, count for everything else."""
    amounts = (T.DoubleType, T.FloatType, T.DecimalType)
    return {
        f.name: "sum" if isinstance(f.dataType, amounts) else "count"
        for f in df.schema.fields
        if f.name not in keys
    }


def kpi(df: DataFrame, trend: str, indicator: Column, goal: Column) -> DataFrame:
    """Indicator and goal at the last point of the trend, and their difference."""
    points = df.groupBy(trend).agg(indicator.alias("_i"), goal.alias("_g"))
    last = points.agg(
        F.max(trend).alias(trend), F.max_by("_i", trend).alias("indicator"), F.max_by("_g", trend).alias("goal")
    )
    gap = F.col("indicator") - F.col("goal")
    return last.select(
        trend, "indicator", "goal", gap.alias("difference"),
        F.try_divide(gap, F.col("goal")).alias("difference_share"),
    )


def calendar_drill(df: DataFrame, date: str, level: str, *aggregates: Column, subtotals: bool = False) -> DataFrame:
    """Aggregate by year[, quarter[, month[, day]]], optionally with subtotals."""
    d = F.col(date)
    parts = {"Year": F.year(d), "Quarter": F.quarter(d), "Month": F.month(d), "Day": F.dayofmonth(d)}
    parts = {name: part.cast("long") for name, part in parts.items()}
    names = list(parts)[: list(parts).index(level) + 1]
    dated = df.withColumns({n: parts[n] for n in names})
    if not subtotals:
        return dated.groupBy(*names).agg(*aggregates)
    rolled = dated.rollup(*names)
    return rolled.agg(F.bit_count(F.grouping_id()).alias("grouping_level"), *aggregates)

"""Window operators on bounded groups, sorting and limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F



def dense_grid(df: DataFrame, days: DataFrame, date: str, keys: Sequence[str]) -> DataFrame:
    """Every key on every day of the calendar; days without a row stay empty.

    ``days`` is a calendar (one row per day). Each key carries the array of its
    days, so the grid grows as keys × days without pairing two tables.
    """
    span = days.agg(F.array_sort(F.collect_set("Datum")).alias("_days")).scalar()
    if not keys:
        grid = days.select(F.col("Datum").alias(date))
    else:
        grid = df.select(*keys).distinct().withColumn(date, F.explode(span))
    on = [*keys, date]
    renamed = df.withColumnsRenamed({c: f"_r_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return grid.join(renamed, same, "left").drop(*[f"_r_{c}" for c in on])


def cumulative_ytd(df: DataFrame, value: str, date: str, keys: Sequence[str] = (), name: str = "ytd") -> DataFrame:
    """Running total from 1 January, per key and year.

    Works on one row per key and day (aggregate first), so a window group holds
    at most 366 rows.
    """
    frame = (
        Window.partitionBy(*keys, F.year(date))
        .orderBy(date)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(name, F.sum(value).over(frame))


def running_points(df: DataFrame, value: str, date: str, keys: Sequence[str] = (), name: str = "ytd") -> DataFrame:
    """Running totals from 1 January where they change: (keys, date, name, valid_to), one row per key and day with rows.

    A total holds from its date to ``valid_to``, the day before the next change or the end of the year. So the result is
    never longer than the rows, however long the calendar is and however many keys there are.
    """
    daily = df.groupBy(*keys, F.to_date(date).alias(date)).agg(F.sum(value).alias("_sum"))
    year = Window.partitionBy(*keys, F.year(date)).orderBy(date)
    last = F.date_sub(F.add_months(F.trunc(date, "year"), 12), 1)
    return daily.select(
        *keys, date, F.sum("_sum").over(year.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(name),
        F.coalesce(F.date_sub(F.lead(date).over(year), 1), last).alias("valid_to"),
    )


def running_on(points: DataFrame, asked: DataFrame, date: str, keys: Sequence[str] = (), name: str = "ytd") -> DataFrame:
    """The running totals of ``points`` on the days that are asked for: ``asked`` (keys, date) with the total that holds there.

    Points and questions of a key and year are read side by side in the order of days, so nothing is paired: the work is
    that of sorting both. A day before the first change of its year has no total.
    """
    on = [*[F.col(k) for k in keys], F.col(date)]
    both = points.select(*on, F.lit(0).alias("_asked"), F.col(name)).unionByName(asked.select(*on[:-1], F.to_date(date).alias(date), F.lit(1).alias("_asked"), F.lit(None).alias(name)))
    so_far = Window.partitionBy(*keys, F.year(date)).orderBy(date, "_asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return both.withColumn(name, F.last(name, ignorenulls=True).over(so_far)).where("_asked = 1").drop("_asked")


def sort(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*columns)


def top(df: DataFrame, n: int, columns: Sequence[str | Column]) -> DataFrame:
    """The first n rows of an order: a top-k per task, then one merge."""
    return df.orderBy(*columns).limit(n)


def sort_by(df: DataFrame, column: str, key: str, reverse: bool = False) -> DataFrame:
    """Members of a label column in the order of another column."""
    members = df.groupBy(column).agg(F.min(key).alias("_sort"))
    order = F.col("_sort").desc() if reverse else F.col("_sort").asc()
    return members.orderBy(order, column).withColumnRenamed("_sort", key)


def reversed_month(month: Column) -> Column:
    """13 - month: sorts month names from December to January."""
    return (F.lit(13) - month).cast("long")


def share_of_total(df: DataFrame, value: str, name: str = "share") -> DataFrame:
    """Part of the grand total, for category charts."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(name, F.try_divide(F.col(value), total))



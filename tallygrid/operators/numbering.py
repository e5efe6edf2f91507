"""Row numbers, surrogate keys and ranks over a whole table.

A window without partitions would pull every row into one task. Here the rows
are range-partitioned on a total order instead, numbered inside each range, and
the ranges are offset by the row counts before them: the only thing that meets
in one place is one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallygrid.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id: range number above, row below


def _order(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(f"`{o}`").asc() if isinstance(o, str) else o for o in order]


def with_index(df: DataFrame, order: Sequence[str | Column], name: str = "Index", start: int = 1) -> DataFrame:
    """Add a running number in the given order.

    The order should end in a unique key: equal rows are numbered arbitrarily
    and all land in one range. The sorted rows are checkpointed once, so that
    counts and rows come from the same ranges even if an executor is lost.
    """
    columns = _order(order)
    placed = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    placed = cut_lineage(placed.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    # one row per range: bounded by the number of partitions
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return numbered.withColumn(name, (F.col("_before") + row + start).cast("long")).drop(
        "_place", "_part", "_before"
    )


def surrogate_key(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """Number rows from 1 by business key; ties need a unique last column."""
    return with_index(df, order, name)


def row_number_by(df: DataFrame, part: Sequence[str], order: Sequence[str | Column], name: str = "RowNum") -> DataFrame:
    """Number the rows of each key in order.

    Rows are numbered over the whole table, sorted by key and then by the order;
    a row's number within its key is the distance to the first of its key. A key
    that holds a large part of the table is so spread over many tasks.
    """
    numbered = with_index(df, [*part, *order], "_row")
    first = numbered.groupBy(*[F.col(f"`{c}`").alias(f"_p{i}") for i, c in enumerate(part)]).agg(
        F.min("_row").alias("_first")
    )
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_p{i}")) for i, c in enumerate(part)]
    joined = numbered.join(first, same)
    return joined.withColumn(name, F.col("_row") - F.col("_first") + 1).drop(
        "_row", "_first", *[f"_p{i}" for i in range(len(part))]
    )


def rank_dense(df: DataFrame, value: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """Dense rank over all members: number the distinct values, then look them up.

    Distinct values are found with partial aggregation, so many members sharing
    one value do not pile up in one task.
    """
    c = F.col(f"`{value}`")
    distinct = df.select(c.alias("_value")).distinct()
    order = F.col("_value").desc_nulls_last() if descending else F.col("_value").asc_nulls_first()
    ranks = with_index(distinct, [order], "_rank")
    return (
        df.join(ranks, c.eqNullSafe(F.col("_value")), "left")
        .withColumn(name, F.col("_rank"))
        .drop("_value", "_rank")
    )

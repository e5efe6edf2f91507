"""Writers: overwrite, append, idempotent replacement per partition, typed copies, layers."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallygrid.functions.dates import to_day
from tallygrid.operators.columns import cast_columns, select_columns
from tallygrid.operators.quality import table_exists
from tallygrid.session import scratch_path


def write_table(df: DataFrame, target: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Write to a catalog table, or to a parquet folder when the target is a path.

    ``overwrite`` replaces the schema too. ``append`` may bring new columns: readers merge those of
    a folder, a catalog table is widened first; columns that the rows lack stay empty.
    """
    if mode == "append" and "/" not in target and table_exists(df.sparkSession, target):
        df = _widened(df, target)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        writer.parquet(target)
    else:
        writer.option("overwriteSchema", "true").format("parquet").saveAsTable(target)


def _widened(df: DataFrame, target: str) -> DataFrame:
    """Adds the columns of ``df`` that a catalog table lacks to the table, and the table's others to ``df``."""
    spark = df.sparkSession
    before = {f.name.lower() for f in spark.table(target).schema}
    new = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name.lower() not in before]
    if new:
        spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({', '.join(new)})")
    present = {c.lower() for c in df.columns}
    empty = {f.name: F.lit(None).cast(f.dataType) for f in spark.table(target).schema if f.name.lower() not in present}
    return df.withColumns(empty) if empty else df


def write_if_any(df: DataFrame, target: str, mode: str = "append") -> bool:
    """Write only when there are rows; tells whether it did."""
    if df.isEmpty():
        return False
    write_table(df, target, mode)
    return True


def replace_partition(df: DataFrame, path: str, column: str, days: Sequence[dt.date | str]) -> None:
    """Replace the given days of a day-partitioned folder by the rows of ``df``.

    Only the days named may occur in ``df``. A rerun gives the same table; other
    days are not touched; a named day without rows ends up empty.
    """
    spark, wanted = df.sparkSession, {to_day(d) for d in days}

    def days_of(rows: DataFrame) -> set[dt.date]:
        """At most one row per named day comes back."""
        return {row[0] for row in rows.select(F.col(column).cast("date")).distinct().limit(len(wanted) + 1).collect()}

    present = days_of(df)
    if not present <= wanted:
        raise ValueError(f"rows outside the days to replace: {sorted(map(str, present - wanted))}")
    filled = set()
    if wanted > present and table_exists(spark, path):
        # only the partitions of the named days are opened
        filled = days_of(spark.read.parquet(path).filter(F.col(column).isin(sorted(wanted - present))))
    if present:
        # rebalanced by day: few files per day, while a day with very many rows is still split
        placed = df.hint("rebalance", F.col(column))
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(column).parquet(path)
    nothing = df.drop(column).filter(F.lit(False))
    for day in sorted(filled):
        nothing.coalesce(1).write.mode("overwrite").parquet(f"{path}/{column}={day.isoformat()}")


def overwrite_in_place(df: DataFrame, target: str) -> None:
    """Overwrite a folder or catalog table that ``df`` itself reads, by way of a staged copy."""
    spark = df.sparkSession
    staged = scratch_path(spark, "staged")
    df.write.parquet(staged)
    write_table(spark.read.parquet(staged), target)


def copy_table(src: DataFrame, target: str, casts: Mapping[str, str], columns: Sequence[str] | None = None) -> None:
    """Copy with type conversion; a value that does not fit its new type becomes empty."""
    chosen = select_columns(src, columns) if columns else src
    write_table(cast_columns(chosen, casts), target)


# --- fixed values: the layers, in load order ------------------------------------------------
LAYERS = ["s1_pre", "s2_stg", "s3_ods", "s4_inf"]
# ---------------------------------------------------------------------------------------------


def build_layer(
    spark: SparkSession, root: str, layer: str, dimensions: Mapping[str, Callable[[], DataFrame]],
    facts: Mapping[str, Callable[[], DataFrame]],
) -> list[str]:
    """Write the tables of one layer below ``root``, dimensions before the facts that look them up."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer}")
    written = []
    for name, build in [*dimensions.items(), *facts.items()]:
        path = f"{root}/{layer}/{name}"
        write_table(build(), path)
        written.append(path)
    return written

"""JSON, maps, structs and arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallygrid.operators.columns import NAME_LIMIT, quoted, unique_names
from tallygrid.operators.quality import table_exists
from tallygrid.session import scratch_path

TAGS = T.MapType(T.StringType(), T.StringType())
HIDDEN_PREFIX = "hidden-link:"


def parse_tags(df: DataFrame, column: str, target: str | None = None) -> DataFrame:
    """JSON text to a map of text; text that is no JSON object gives an empty value."""
    return df.withColumn(target or column, F.from_json(quoted(column), TAGS))


def map_key_set(df: DataFrame, column: str) -> list[str]:
    """All keys of a map column, each once, found with partial aggregation.

    They come to the driver because they become the columns of a schema. Where keys
    are open-ended, pass the wanted ones to ``widen_map`` and keep the rest as a map.
    """
    keys = df.select(F.explode(F.map_keys(quoted(column))).alias("k")).distinct()
    return sorted(r.k for r in keys.collect())


def usable_keys(keys: Sequence[str]) -> list[str]:
    return [k for k in keys if len(k) <= NAME_LIMIT and not k.startswith(HIDDEN_PREFIX)]


def widen_map(df: DataFrame, column: str, keys: Sequence[str] | None = None, rest: str | None = None) -> DataFrame:
    """One column per key of the map, in a single projection.

    ``rest`` names a map column for the entries whose key has no column of its own, so
    that a table with any number of other keys loses none of them.
    """
    keys = usable_keys(map_key_set(df, column) if keys is None else keys)
    names = unique_names([*df.columns, *keys])[len(df.columns) :]
    others = []
    if rest:
        known = F.array(*map(F.lit, keys)) if keys else F.array().cast("array<string>")
        others = [F.map_filter(quoted(column), lambda k, _: ~F.array_contains(known, k)).alias(rest)]
    return df.select("*", *[F.try_element_at(quoted(column), F.lit(k)).alias(n) for k, n in zip(keys, names)], *others)


def key_counts(df: DataFrame, column: str) -> DataFrame:
    """(key, rows): every key of a map column with the number of rows that hold it."""
    return df.select(F.explode(F.map_keys(quoted(column))).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("rows"))


def update_keys(df: DataFrame, column: str, dictionary: str, share: float) -> list[str]:
    """Brings the keys of a load into a stored dictionary (key, rows, wide) and returns those that have a column, sorted.

    A key gets a column once it is in ``share`` of a load's rows or more, and keeps it. So no more than the keys of
    an average row over ``share`` get one, however many different keys there are: only these reach the driver. The
    dictionary itself is joined and written by Spark.
    """
    spark = df.sparkSession
    rows = df.count()
    found = key_counts(df, column)
    usable = (F.length("key") <= NAME_LIMIT) & ~F.col("key").startswith(HIDDEN_PREFIX)
    found = found.select("key", "rows", (usable & (F.col("rows") >= share * max(rows, 1))).alias("wide"))
    if table_exists(spark, dictionary):
        both = spark.read.parquet(dictionary).unionByName(found)
        found = both.groupBy("key").agg(F.sum("rows").alias("rows"), F.max("wide").alias("wide"))
        staged = scratch_path(spark, "keys")
        found.write.parquet(staged)
        found = spark.read.parquet(staged)
    found.write.mode("overwrite").parquet(dictionary)
    return sorted(r.key for r in spark.read.parquet(dictionary).where("wide").select("key").collect())


def split_map(df: DataFrame, column: str, keys: Sequence[str], row: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """A table with one column per key of ``keys``, and a long one (``row`` columns, key, value) for all other entries.

    Together they hold every entry; neither has a column or a value on the driver for the other keys.
    """
    wide = widen_map(df, column, keys).drop(column)
    known = F.array(*map(F.lit, keys)) if keys else F.array().cast("array<string>")
    rest = df.select(*[quoted(c) for c in row], F.explode(F.map_filter(quoted(column), lambda k, _: ~F.array_contains(known, k))).alias("key", "value"))
    return wide, rest


def explode_list(df: DataFrame, column: str, target: str | None = None) -> DataFrame:
    """One row per element; a row without elements stays, with an empty value."""
    return df.withColumn(target or column, F.explode_outer(quoted(column)))


def expand_record(df: DataFrame, column: str, fields: Mapping[str, str]) -> DataFrame:
    """Fields of a struct (dotted paths) to columns; the struct itself goes."""
    rest = [quoted(c) for c in df.columns if c != column]
    return df.select(*rest, *[F.col(f"`{column}`.{path}").alias(name) for path, name in fields.items()])


def expand_teams(df: DataFrame, column: str, name: str = "TeamName") -> DataFrame:
    """One row per value of a multi-valued field. Other amounts repeat per value."""
    exploded = explode_list(df, column)
    rest = [quoted(c) for c in df.columns if c != column]
    return exploded.select(*rest, F.col(f"{column}.name").alias(name))


def default_if_missing(c: Column, value: Column) -> Column:
    return F.coalesce(c, value)


def list_of(items: Column, path: str) -> Column:
    """One field of every element of a list, missing parts as empty values."""

    def pick(element: Column) -> Column:
        for part in path.split("."):
            element = element.getField(part)
        return element

    return F.transform(items, pick)



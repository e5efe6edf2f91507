"""Lookups and restrictions.

No broadcast hints: sizes are checked at run time by adaptive execution, which
turns a small side into a broadcast and splits skewed partitions otherwise. It splits
a hot key only where both sides come straight from an exchange. A side that has just been
reduced to one row per key has none left, so such joins also compare a hash of the key
(``on_key``): the reduced side is then dealt out once more, small as it is, and the hot key of the other is split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallygrid.operators.columns import quoted


def _pairs(on: str | Sequence[str] | dict[str, str]) -> dict[str, str]:
    if isinstance(on, str):
        return {on: on}
    return dict(on) if isinstance(on, dict) else {c: c for c in on}


def _comparable(left: T.DataType, right: T.DataType) -> str | None:
    """The type in which equal keys have equal hashes; none where an implicit cast decides what is equal."""
    if left == right:
        return left.simpleString()
    return "bigint" if isinstance(left, T.IntegralType) and isinstance(right, T.IntegralType) else None


def on_key(left: DataFrame, right: DataFrame, pairs: dict[str, str], how: str, step: int = 0) -> DataFrame:
    """Equi-join with a right side that was reduced by the same keys; a hot key of the left side can be split.

    ``pairs`` names the key columns, which differ between the sides; those of the right side go. Joins that
    follow each other over the same key number their ``step``, so that the hashes differ.
    """
    test = [quoted(a) == quoted(b) for a, b in pairs.items()]
    types = [_comparable(left.schema[a].dataType, right.schema[b].dataType) for a, b in pairs.items()]
    drop = [b for b in pairs.values() if b in right.columns]
    if all(types):
        right = right.withColumn("_hash", F.xxhash64(F.lit(step), *[quoted(b).cast(t) for b, t in zip(pairs.values(), types)]))
        test.append(F.xxhash64(F.lit(step), *[quoted(a).cast(t) for a, t in zip(pairs, types)]) == F.col("_hash"))
        drop.append("_hash")
    joined = left.join(right, test, how)
    return joined if how == "left_semi" else joined.drop(*drop)


def lookup(fact: DataFrame, dim: DataFrame, on, columns: Sequence[str]) -> DataFrame:
    """Add columns of a dimension; orphans keep their row with empty values."""
    pairs = _pairs(on)
    right = dim.select(
        *[quoted(k).alias(f"_k{i}") for i, k in enumerate(pairs.values())],
        *[quoted(c) for c in columns],
    )
    test = [quoted(s) == F.col(f"_k{i}") for i, s in enumerate(pairs)]
    return fact.join(right, test, "left").drop(*[f"_k{i}" for i in range(len(pairs))])


def with_dim(fact: DataFrame, dim: DataFrame, on, columns: Sequence[str]) -> DataFrame:
    return lookup(fact, dim, on, columns)


def lookup_keys(df: DataFrame, dim: DataFrame, on, key: str) -> DataFrame:
    """Surrogate-key lookup; the dimension is reduced to one key per business key."""
    pairs = _pairs(on)
    named = [quoted(k).alias(f"_k{i}") for i, k in enumerate(pairs.values())]
    one = dim.groupBy(*named).agg(F.min(quoted(key)).alias(key))
    return on_key(df, one, {s: f"_k{i}" for i, s in enumerate(pairs)}, "left")


def join_expand(a: DataFrame, b: DataFrame, on, columns: Sequence[str]) -> DataFrame:
    """Left join that may match several rows, keeping chosen columns of the right side."""
    return lookup(a, b, on, columns)


def restrict_by(df: DataFrame, values: DataFrame, on) -> DataFrame:
    """Keep rows whose key occurs in another table (virtual relationship)."""
    pairs = _pairs(on)
    right = values.select(*[quoted(k).alias(f"_k{i}") for i, k in enumerate(pairs.values())])
    return on_key(df, right.distinct(), {s: f"_k{i}" for i, s in enumerate(pairs)}, "left_semi")


def narrow_dim(dim: DataFrame, fact: DataFrame, on) -> DataFrame:
    """Keep the members of a dimension that the (filtered) fact uses."""
    return restrict_by(dim, fact, on)


def with_date(fact: DataFrame, ts: str, days: DataFrame, columns: Sequence[str], date: str = "Datum") -> DataFrame:
    """Look up the date dimension by the date part of a timestamp."""
    right = days.select(F.col(date).alias("_day"), *columns)
    return fact.join(right, F.to_date(quoted(ts)) == F.col("_day"), "left").drop("_day")


def text_key(c: Column) -> Column:
    """Normalised business text: trimmed, case ignored."""
    return F.lower(F.trim(c))


def with_dim_by_text(fact: DataFrame, dim: DataFrame, fact_text: Column, dim_text: Column, columns: Sequence[str]) -> DataFrame:
    """Look up by business text such as a name; a doubled name counts once."""
    right = dim.groupBy(text_key(dim_text).alias("_text")).agg(
        *[F.min(quoted(c)).alias(c) for c in columns]
    )
    return on_key(fact.withColumn("_own_text", text_key(fact_text)), right, {"_own_text": "_text"}, "left").drop("_own_text")

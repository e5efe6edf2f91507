"""Projections, renames, typing."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallygrid.operators.numbering import with_index

NAME_LIMIT = 120


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in columns])


def drop_columns(df: DataFrame, pattern: str) -> DataFrame:
    """Drop every column whose name contains the pattern."""
    return df.drop(*[c for c in df.columns if pattern in c])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def safe_name(name: str, limit: int = NAME_LIMIT) -> str:
    return re.sub(r"\W+", "_", name.strip())[:limit]


def unique_names(names: Sequence[str], limit: int = NAME_LIMIT) -> list[str]:
    """Safe names; a later clash is shortened, and numbered if that is not enough."""
    taken: set[str] = set()
    result = []
    for name in names:
        candidate = safe_name(name, limit)
        while candidate.lower() in taken and len(candidate) > 1:
            candidate = candidate[:-1]
        base, n = candidate, 1
        while candidate.lower() in taken or not candidate:
            n += 1
            candidate = f"{base[: limit - 6]}_{n}"
        taken.add(candidate.lower())
        result.append(candidate)
    return result


def safe_names(df: DataFrame, unique: bool = False) -> DataFrame:
    names = unique_names(df.columns) if unique else [safe_name(c) for c in df.columns]
    return df.toDF(*names)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Change types; a value that does not fit becomes empty."""
    return df.withColumns({c: quoted(c).try_cast(t) for c, t in types.items()})


def type_errors(df: DataFrame, schema: Mapping[str, str], key: Sequence[str]) -> DataFrame:
    """Rows with a value that does not fit its declared type, with their row number."""
    bad = None
    for name, kind in schema.items():
        test = quoted(name).isNotNull() & quoted(name).try_cast(kind).isNull()
        bad = test if bad is None else bad | test
    numbered = with_index(df, key, name="Row Number")
    return reorder(numbered.filter(bad), ["Row Number"])


def reorder(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """Put the named columns first and keep the rest in order."""
    rest = [c for c in df.columns if c not in first]
    return select_columns(df, [*first, *rest])


def with_const(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def with_nulls(df: DataFrame, columns: Mapping[str, str | T.DataType]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items()})

"""Registered queries, each with the SQL that verifies it."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tallygrid.checks.shapes import with_shapes
from tallygrid.operators.columns import quoted
from tallygrid.plans.evaluate import evaluate
from tallygrid.plans.metric import Metric

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIGITS = 4  # sums of doubles differ in the last bits between engines


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = with_shapes(sql)
        return build

    return register


def rounded(df: DataFrame) -> DataFrame:
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[F.round(quoted(c), DIGITS).alias(c) if c in doubles else quoted(c) for c in df.columns])


def plain(name: str) -> str:
    """Metric name as a plain column name."""
    return re.sub(r"\W+", "_", name.replace("%", "pct")).strip("_")


def show(model, catalogue: Mapping[str, Metric], names: Iterable[str], **options) -> DataFrame:
    """Evaluate named metrics and round what is a double."""
    names = list(names)
    return rounded(evaluate(model, {plain(n): catalogue[n] for n in names}, **options))


def r(expression: str, metric: str) -> str:
    """A rounded column of a check query, named after its metric."""
    return f'round({expression}, {DIGITS}) AS "{plain(metric)}"'


def n(expression: str, metric: str) -> str:
    """A count of a check query: nothing counted is empty."""
    return f'nullif({expression}, 0) AS "{plain(metric)}"'


"""Unions and the backfill merge."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tallygrid.operators.aggregates import dedupe


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b), frames)


def union_loose(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames whose columns differ; missing columns are empty."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_backfill(new: DataFrame, old: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New and existing rows, one per key; a new row wins over an existing one."""
    both = union_loose([new.withColumn("_new", F.lit(1)), old.withColumn("_new", F.lit(0))])
    return dedupe(both, keys, prefer=["_new"]).drop("_new")

"""Existence probes: does any row break a condition?"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def any_violation(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row, one 0/1 column per condition, all in one aggregate.  Null counts as no violation and an
    empty frame has none."""
    return df.agg(*[F.coalesce(F.max(F.when(c, 1).otherwise(0)), F.lit(0)).alias(n) for n, c in conditions.items()])


def exists(df: DataFrame, condition: Column) -> DataFrame:
    """One row, column ``found``.  Reading stops in each task at its first hit."""
    return df.filter(condition).limit(1).agg((F.count(F.lit(1)) > 0).alias("found"))

"""Append listing rows of several platforms into one table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_text(df: DataFrame, keep_types: tuple[str, ...] = ()) -> DataFrame:
    """Every column cast to string (raw fields stay text until the clean stage,
    so a union never widens "1đ" into a number column)."""
    return df.select(*[F.col(c) if c in keep_types else F.col(c).cast("string").alias(c) for c in df.columns])


def merge_platforms(*dfs: DataFrame, keep_types: tuple[str, ...] = ()) -> DataFrame:
    """Union by column name; columns missing on one side become NULL."""
    if not dfs:
        raise ValueError("nothing to merge")
    texts = [as_text(d, keep_types) for d in dfs]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), texts)

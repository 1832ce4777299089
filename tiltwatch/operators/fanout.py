"""Counting the pairs of a many-to-many join without forming them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per_key(df: DataFrame, keys: Sequence[str], counted: str, prefix: str) -> DataFrame:
    """Per key: ``{prefix}_rows`` and ``{prefix}_{counted}`` (non-NULL values)."""
    return df.groupBy(*keys).agg(
        F.count("*").alias(f"{prefix}_rows"),
        F.count(counted).alias(f"{prefix}_{counted}"),
    )


def pair_counts(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Per key, how many row pairs an inner join on ``key`` would form.

    Each side folds to one row per key before the shuffle, so the work follows
    the input and not the number of pairs.
    """
    left_counts = left.groupBy(key).agg(F.count("*").alias("left_rows"))
    right_counts = right.groupBy(key).agg(F.count("*").alias("right_rows"))
    pairs = (F.col("left_rows") * F.col("right_rows")).alias("pairs")
    return left_counts.join(right_counts, key).select(key, pairs)

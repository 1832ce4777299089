"""Equi-joins that stay balanced when one key holds a large share of the rows.

Adaptive execution splits a skewed sort-merge join only if both inputs are
plain shuffles. In the reports one input is an aggregate already partitioned on
the join key, so that rule never fires there. Here the few hot keys are found
first and joined without a shuffle; all others take the ordinary shuffle join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot above this share of all rows, so there are always fewer than
# 10,000 hot keys and their list is safe to broadcast, without any cap.
HOT_SHARE = 1 / 10_000


def hot_levels(df: DataFrame, keys: Sequence[str], hot_share: float = HOT_SHARE) -> list[DataFrame]:
    """The hot keys of the first column, of the first two, and so on; see :func:`hot_keys`."""
    keys = list(keys)
    levels: list[DataFrame] = []
    total, found = None, []
    for i in range(1, len(keys) + 1):
        part = keys[:i]
        schema = df.select(*part).schema
        if not levels or found:
            rows = df.select(*part)
            if levels:
                rows = rows.join(F.broadcast(levels[-1]), keys[: i - 1], "left_semi")
            counts = rows.groupBy(*part).agg(F.count("*").alias("hot_key_rows")).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                if total is None:
                    total = counts.agg(F.sum("hot_key_rows").alias("n")).first()["n"] or 0
                found = counts.filter(F.col("hot_key_rows") > total * hot_share).select(*part).collect()
            finally:
                counts.unpersist()
        levels.append(df.sparkSession.createDataFrame(found, schema))
    return levels


def hot_keys(df: DataFrame, keys: Sequence[str], hot_share: float = HOT_SHARE) -> DataFrame:
    """The keys that have more than ``hot_share`` of the rows of ``df``, looked up at once.

    Fewer than ``1 / hot_share`` keys can, at any size, and only they reach the
    driver; a key not listed has
    at most that share and is safe in the shuffle join. Composite keys are
    narrowed one column at a time: a pair can only be hot if its first column
    is, so nearly unique key combinations are never shuffled, and nothing is read
    for them where no first column is hot. Rows are counted per key and in all in one scan. The choice
    depends on the data alone, so evaluating it twice gives the same list.
    """
    return hot_levels(df, keys, hot_share)[-1]


def split_join(
    fact: DataFrame, per_key: DataFrame, keys: Sequence[str], hot: DataFrame
) -> DataFrame:
    """Inner join of ``fact`` with a side that has one or few rows per key.

    Rows with a key in ``hot`` meet a broadcast of that key's ``per_key`` rows
    where they are, so however many they are, or how alike, they are not moved.
    The broadcast is bounded as ``hot_keys`` is. The rest is a shuffle join.
    Without hot keys there is nothing but that.
    """
    keys = list(keys)
    if hot.isEmpty():
        return fact.join(per_key, keys)
    hot = F.broadcast(hot)
    cold_rows = fact.join(hot, keys, "left_anti").join(per_key, keys)
    # An inner join, as Catalyst would move a semi-join below the aggregate that
    # made ``per_key`` and so compute it twice; the list has each key once.
    hot_side = per_key.join(hot, keys)
    hot_rows = fact.join(hot, keys, "left_semi").join(F.broadcast(hot_side), keys)
    return cold_rows.unionByName(hot_rows)

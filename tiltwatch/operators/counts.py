"""Several labelled counts from one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_counts(
    df: DataFrame, conditions: dict[str, Column], name: str, count: str
) -> DataFrame:
    """One output row per condition with the number of rows meeting it.

    Stands for a UNION of filtered ``count(*)`` branches, but scans once and
    shuffles one partial row per task. A condition that no row meets keeps its
    row with 0.
    """
    rows = F.array(
        *[
            F.struct(F.lit(label).alias(name), F.count_if(condition).alias(count))
            for label, condition in conditions.items()
        ]
    )
    return df.agg(rows.alias("counts")).select(F.inline("counts"))


def grouped_counts(
    df: DataFrame, groups: dict[str, dict[str, Column]], group: str, name: str, count: str
) -> DataFrame:
    """``labelled_counts`` for several groups of conditions, still in one scan."""
    rows = F.array(
        *[
            F.struct(
                F.lit(title).alias(group),
                F.lit(label).alias(name),
                F.count_if(condition).alias(count),
            )
            for title, conditions in groups.items()
            for label, condition in conditions.items()
        ]
    )
    return df.agg(rows.alias("counts")).select(F.inline("counts"))


#: Conditions that one 64-bit mask holds.
_MASK_BITS = 63


def labelled_distinct_counts(
    df: DataFrame,
    key: str,
    conditions: dict[str, Column],
    name: str,
    count: str,
    percent: str | None = None,
) -> DataFrame:
    """Per condition, the number of distinct ``key`` values with a row meeting it.

    Rows first fold to one row per key with a bit per condition (partially
    before the shuffle, so a hot key costs one row per task); the bits are then
    counted. Bits of one number take a fraction of the memory of as many flags, which
    counts where nearly every row has a key of its own. ``percent`` adds the rounded share of all distinct keys.
    """
    places = {label: (f"mask_{i // _MASK_BITS}", F.lit(1 << i % _MASK_BITS).cast("long")) for i, label in enumerate(conditions)}
    masks: dict[str, Column] = {}
    for label, (mask, bit) in places.items():
        met = F.when(conditions[label], bit).otherwise(F.lit(0).cast("long"))
        masks[mask] = masks[mask].bitwiseOR(met) if mask in masks else met
    per_key = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(*[F.bit_or(value).alias(mask) for mask, value in masks.items()])
    )
    rows = F.array(
        *[
            F.struct(F.lit(label).alias(name), F.count_if(F.col(mask).bitwiseAND(bit) != 0).alias(count))
            for label, (mask, bit) in places.items()
        ]
    )
    totals = per_key.agg(F.count("*").alias("total"), rows.alias("counts"))
    counted = totals.select("total", F.inline("counts"))
    if percent is None:
        return counted.select(name, count)
    share = F.round(F.try_divide(F.col(count), F.col("total")) * 100)
    return counted.select(name, count, share.alias(percent))


def top_k(df: DataFrame, by: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ``tie_break`` makes the choice definite."""
    return df.orderBy(F.desc(by), *[F.asc(c) for c in tie_break]).limit(k)

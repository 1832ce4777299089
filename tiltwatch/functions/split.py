"""Splitting rows by a hash of their key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HASH_RANGE = 2**32


def key_position(key: str, salt: str = "") -> Column:
    """A key's place in [0, 2**32), from the first 32 bits of its md5; NULL is placed like ''."""
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    text = F.concat(F.lit(salt), text) if salt else text
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _bounds(weights: Sequence[float]) -> list[tuple[int, int]]:
    total = float(sum(weights))
    ends = [0]
    for weight in weights:
        ends.append(ends[-1] + int(weight / total * _HASH_RANGE))
    ends[-1] = _HASH_RANGE
    return list(zip(ends, ends[1:]))


def split_part(
    key: str, names: Sequence[str], weights: Sequence[float] = (0.8, 0.2), salt: str = ""
) -> Column:
    """The name of the part a row belongs to, for labelling rows in one pass."""
    position = key_position(key, salt)
    part = F.lit(None).cast("string")
    for name, (low, high) in zip(names, _bounds(weights)):
        part = F.when((position >= low) & (position < high), F.lit(name)).otherwise(part)
    return part


def hash_split(
    df: DataFrame, key: str, weights: Sequence[float] = (0.8, 0.2), salt: str = ""
) -> list[DataFrame]:
    """Disjoint parts of ``df`` in about the given shares, together all its rows.

    A row's part depends on its key alone, so unlike ``randomSplit`` the parts
    stay the same when partitioning, file layout or row order change, and a
    retried task can never move a row. No shuffle.
    """
    position = key_position(key, salt)
    return [df.filter((position >= low) & (position < high)) for low, high in _bounds(weights)]

"""Column expressions over label sets and multi-hot flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiltwatch.config import LABELS


def flag_is_set(flag: str | Column) -> Column:
    """True where a flag column holds 1, whether stored as text or number."""
    column = F.col(flag) if isinstance(flag, str) else flag
    return column.cast("int") == 1


def label_set(flags: dict[str, Column]) -> Column:
    """``array<string>`` of the labels whose condition is true, in dict order.

    Unset places hold an empty string that is then removed: unlike a filter with
    a lambda, this stays inside generated code.
    """
    places = [F.when(cond, F.lit(label)).otherwise(F.lit("")) for label, cond in flags.items()]
    return F.array_remove(F.array(*places), "")


def has_label(column: str | Column, label: str) -> Column:
    return F.array_contains(column, label)


def label_vector(column: str | Column, labels: Sequence[str] = LABELS) -> Column:
    """Positional 0/1 ``array<double>`` of a label set."""
    return F.array(
        *[F.when(has_label(column, label), F.lit(1.0)).otherwise(F.lit(0.0)) for label in labels]
    )


def prepare_labels(
    df: DataFrame,
    labels: Sequence[str] = LABELS,
    drop_unlabelled: bool = False,
) -> DataFrame:
    """Multi-hot flag columns to a label set and a truth vector, in one projection.

    Each flag ``x`` is kept as ``x_true``; ``labels`` holds the names of the set
    flags and ``label_true`` their positional values. Every row is kept unless
    ``drop_unlabelled`` is given.
    """
    names = set(labels)
    others = [c for c in df.columns if c not in names]
    prepared = df.select(
        *others,
        *[F.col(label).alias(f"{label}_true") for label in labels],
        label_set({label: flag_is_set(label) for label in labels}).alias("labels"),
        F.array(*[F.col(label).cast("double") for label in labels]).alias("label_true"),
    )
    return prepared.filter(F.size("labels") > 0) if drop_unlabelled else prepared

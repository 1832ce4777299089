"""Multi-label quality measures, each from one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiltwatch.config import LABELS
from tiltwatch.functions.labels import has_label


def _ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom``, 0 where nothing was there to count."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(F.try_divide(top, bottom))


def label_scores(
    df: DataFrame, truth: str, predicted: str, labels: Sequence[str] = LABELS
) -> DataFrame:
    """Per label: true/false positives, false negatives, precision, recall, F1."""
    rows = []
    for label in labels:
        real = F.coalesce(has_label(truth, label), F.lit(False))
        said = F.coalesce(has_label(predicted, label), F.lit(False))
        rows.append(
            F.struct(
                F.lit(label).alias("label"),
                F.count_if(real & said).alias("tp"),
                F.count_if(~real & said).alias("fp"),
                F.count_if(real & ~said).alias("fn"),
            )
        )
    counted = df.agg(F.array(*rows).alias("scores")).select(F.inline("scores"))
    return counted.select(
        "label",
        "tp",
        "fp",
        "fn",
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def document_scores(
    df: DataFrame, truth: str, predicted: str, labels: Sequence[str] = LABELS
) -> DataFrame:
    """One row of measures over label sets; two empty sets agree fully.

    ``agreement_f1`` is what an evaluator for label ids returns when it is
    handed positional 0/1 vectors instead: it only compares how many slots are
    set, not which.
    """
    width = len(labels)
    known = F.array(*[F.lit(label) for label in labels])
    real = F.array_intersect(F.coalesce(F.col(truth), F.array().cast("array<string>")), known)
    said = F.array_intersect(F.coalesce(F.col(predicted), F.array().cast("array<string>")), known)
    sized = df.select(
        F.size(F.array_intersect(real, said)).cast("bigint").alias("both"),
        F.size(real).cast("bigint").alias("real"),
        F.size(said).cast("bigint").alias("said"),
    )
    # At most (labels + 1)^3 combinations exist, so all later work is on a few rows.
    shapes = sized.groupBy("both", "real", "said").agg(F.count("*").alias("docs"))
    both, real, said, docs = (F.col(c) for c in ("both", "real", "said", "docs"))
    either = real + said - both
    no_labels = either == 0

    def mean(value: Column) -> Column:
        return F.try_divide(F.sum(value * docs), F.sum(docs))

    def per_document(top: Column, bottom: Column) -> Column:
        return F.when(no_labels, F.lit(1.0)).otherwise(_ratio(top, bottom))

    return shapes.agg(
        F.coalesce(F.sum(docs), F.lit(0)).alias("documents"),
        mean(F.when((both == real) & (both == said), 1.0).otherwise(0.0)).alias("subset_accuracy"),
        mean(per_document(both, either)).alias("accuracy"),
        mean((either - both) / width).alias("hamming_loss"),
        mean(per_document(both, said)).alias("precision"),
        mean(per_document(both, real)).alias("recall"),
        mean(per_document(2 * both, real + said)).alias("f1"),
        _ratio(F.sum(both * docs), F.sum(said * docs)).alias("micro_precision"),
        _ratio(F.sum(both * docs), F.sum(real * docs)).alias("micro_recall"),
        _ratio(2 * F.sum(both * docs), F.sum((real + said) * docs)).alias("micro_f1"),
        mean(1 - F.abs(real - said) / width).alias("agreement_f1"),
    )


def macro_f1(scores: DataFrame) -> DataFrame:
    """The unweighted mean of the per-label F1 values."""
    return scores.agg(F.avg("f1").alias("macro_f1"))

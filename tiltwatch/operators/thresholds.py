"""Decision thresholds chosen from scores and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Scores are told apart to a thousandth.
BINS = 1000


def score_histogram(df: DataFrame, scores: Column, truth: Column, labels: Sequence[str], bins: int = BINS) -> DataFrame:
    """``label, bin, n, n_true`` from one aggregate over the rows.

    ``scores`` is an array of ``(result, confidence)``, one entry per label;
    ``truth`` the array of a row's true labels, NULL for none. Bin ``b`` holds
    the scores above ``b / bins`` and up to ``(b + 1) / bins``; a score of 0 is in bin -1. Missing scores
    count as 0, entries for other labels are left out.
    """
    named = F.array(*map(F.lit, labels))
    one = F.transform(
        named,
        lambda x: F.struct(
            x.alias("label"),
            F.coalesce(F.array_contains(truth, x), F.lit(False)).alias("is_true"),
            F.coalesce(F.try_element_at(F.filter(scores, lambda s: s["result"] == x), F.lit(1))["confidence"], F.lit(0.0)).alias("score"),
        ),
    )
    rows = df.select(F.inline(one))
    return rows.groupBy("label", (F.ceil(F.col("score") * bins) - 1).cast("int").alias("bin")).agg(
        F.count("*").alias("n"), F.count_if("is_true").alias("n_true")
    )


def best_thresholds(histogram: DataFrame, bins: int = BINS) -> DataFrame:
    """``label, threshold, f1``: where the rows scored above the threshold agree best with the labels.

    F1 at every edge comes from running sums over the bins, highest first; of equal F1 the highest
    threshold is taken. A label that no row carries has no row here.
    """
    down = Window.partitionBy("label").orderBy(F.desc("bin"))
    sums = histogram.select(
        "label", "bin", F.sum("n").over(down).alias("chosen"), F.sum("n_true").over(down).alias("right"),
        F.sum("n_true").over(Window.partitionBy("label")).alias("positives"),
    )
    f1 = 2 * F.col("right") / (F.col("chosen") + F.col("positives"))
    best = sums.filter("positives > 0").groupBy("label").agg(F.max(F.struct(f1.alias("f1"), "bin")).alias("best"))
    return best.select("label", (F.col("best.bin") / bins).alias("threshold"), "best.f1")


def choose_thresholds(
    df: DataFrame, scores: Column, truth: Column, labels: Sequence[str], bins: int = BINS
) -> dict[str, float]:
    """The threshold of each label that some row carries; one row per label reaches the driver."""
    chosen = best_thresholds(score_histogram(df, scores, truth, labels, bins), bins)
    return {r["label"]: r["threshold"] for r in chosen.collect()}

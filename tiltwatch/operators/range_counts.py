"""Counting values into ranges given as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def range_counts(
    values: DataFrame,
    value: str,
    ranges: DataFrame,
    bin_width: float = 60,
    bins: int = 1000,
    count: str = "n",
) -> DataFrame:
    """Per row of ``ranges(name, low, high)``, how many values lie in ``[low, high]``.

    Ranges may overlap; a NULL end is open; a range without values keeps its row
    with 0. Values fold to one row per distinct value first. Both sides are then
    cut into bins of ``bin_width``, or wider where the extent of the ranges' ends would
    take more than ``bins``, so the join is an equi-join, which Catalyst may
    broadcast or shuffle by size, and no pair outside a shared bin is formed.
    Results depend on neither.
    """
    folded = (
        values.filter(F.col(value).isNotNull())
        .groupBy(F.col(value).alias("value"))
        .agg(F.count("*").alias("value_rows"))
    )
    # The extent of the ranges' ends, not of the values: those outside it go to the outermost bins, and are read once.
    ends = ranges.select(F.explode(F.array(F.col("low").cast("double"), F.col("high").cast("double"))).alias("end"))
    extent = ends.agg(
        F.struct(F.coalesce(F.min("end"), F.lit(0.0)).alias("low"), F.coalesce(F.max("end"), F.lit(0.0)).alias("high"))
    ).scalar()
    least, most = extent["low"], extent["high"]
    width = F.greatest((most - least) / bins, F.lit(float(bin_width)))

    def bin_of(edge):
        inside = F.least(F.greatest(edge.cast("double"), least), most)
        return F.floor((inside - least) / width)

    folded = folded.withColumn("bin", bin_of(F.col("value")))
    cut = (
        ranges.withColumn("first_bin", F.when(F.col("low").isNull(), F.lit(0)).otherwise(bin_of(F.col("low"))))
        .withColumn("last_bin", bin_of(F.coalesce(F.col("high").cast("double"), most)))
        .filter(F.col("first_bin") <= F.col("last_bin"))
        .withColumn("bin", F.explode(F.sequence("first_bin", "last_bin")))
        .select("name", "low", "high", "bin")
    )
    inside = (F.col("low").isNull() | (F.col("value") >= F.col("low"))) & (
        F.col("high").isNull() | (F.col("value") <= F.col("high"))
    )
    hits = (
        cut.join(folded, "bin")
        .filter(inside)
        .groupBy("name")
        .agg(F.sum("value_rows").alias(count))
    )
    return (
        ranges.select("name")
        .join(hits, "name", "left")
        .select("name", F.coalesce(F.col(count), F.lit(0)).alias(count))
    )

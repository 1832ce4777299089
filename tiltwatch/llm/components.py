"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiltwatch.llm.common import drop_kept, keep


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("hi", "lo")).alias("x")
    ).first()
    return row["n"], row["x"]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node with an edge; root is the least node reachable.

    Large-star and small-star rounds shrink every component to a star around
    its least node in a number of rounds that grows with the logarithm of its
    size. Only a neighbour's minimum is gathered per node, as a partial
    aggregate, never a list. Rounds are written to the shared folder; the
    driver sees two numbers per round.

    NULL ends and loops are ignored; repeated edges count once. No edges give
    an empty result.
    """
    start = edges.select(
        F.greatest(F.col(a), F.col(b)).alias("hi"), F.least(F.col(a), F.col(b)).alias("lo")
    ).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo")))
    now = keep(start.distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionAll(now.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        least = both.groupBy("hi").agg(F.min("lo").alias("m"))
        large = (
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
            .join(least.withColumnRenamed("hi", "u"), "u")
            .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
            .distinct()
        )
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(least, "hi")
            .select(F.explode(F.array(
                F.struct(F.col("hi").alias("hi"), F.col("m").alias("lo")),
                F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")),
            )).alias("e"))
            .select("e.hi", "e.lo")
            .filter(F.col("hi") != F.col("lo"))
            .distinct()
        )
        new = keep(small, "edges")
        new_state = _state(new)
        drop_kept(now)
        now, done = new, new_state == state
        state = new_state
        if done:
            break
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(roots)

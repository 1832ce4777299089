"""k-means over integer vectors, each vector finding its centroid by Orchard's search."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiltwatch.llm.common import keep

#: Components beyond this count as it, so that a squared distance of up to 64 of them fits a long.
LIMIT = 1 << 27
#: Vectors searched at a time.
BATCH = 4096


def integer_vectors(
    vectors: DataFrame, dims: int, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(vec_id, v)``: rows with exactly ``dims`` components, none NULL or non-finite, as floor(scale * x).

    The product is taken in doubles. Other rows, and those without a vector,
    are left out; repeated rows stay repeated; components beyond +-``LIMIT``
    count as that limit.
    """
    number = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    held = F.transform("x", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(LIMIT))), F.lit(float(-LIMIT)))))
    rows = vectors.select(F.col(id_col).alias("vec_id"), number.alias("x")).filter(F.size("x") == dims).filter(~bad)
    return rows.select("vec_id", held.cast("array<int>").alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``; fewer if there are fewer.

    Equal hashes (repeated ids) go by vector; rows without id come last.
    """
    picked = rows.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    picked = picked.orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()
    return np.array([r["v"] for r in picked], dtype=np.int64)


class Orchard:
    """Nearest centroid by walking sorted neighbour lists; exact, ties go to the smaller number.

    Every centroid has the others sorted by distance. A query walks the list
    of the nearest centroid so far and jumps to another's list whenever that
    one is nearer. No centroid is measured twice. The walk stops where a
    neighbour is strictly more than twice as far from the list's centroid as
    the query is, as it can then be no nearer than the centroid itself.
    """

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        k = len(centroids)
        between = np.empty((k, k), dtype=np.int64)
        for i in range(k):
            between[i] = ((centroids - centroids[i]) ** 2).sum(axis=1)
        np.fill_diagonal(between, -1)  # itself comes first, also before equal centroids
        self.order = np.argsort(between, axis=1, kind="stable")[:, 1:]
        self.between = np.take_along_axis(between, self.order, axis=1)
        # A walk begins at the centroid nearest to all others, from where lists are shortest.
        self.start = int(np.argmin(between.astype(float).sum(axis=1)))

    def _distance(self, queries: np.ndarray, which: np.ndarray) -> np.ndarray:
        apart = queries - self.centroids[which]
        return np.einsum("ij,ij->i", apart, apart)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(centroid, squared distance)`` of each query; all queries walk side by side."""
        n, k = len(queries), len(self.centroids)
        at = np.full(n, self.start, dtype=np.int64)
        best = self._distance(queries, at)
        seen = np.zeros((n, k), dtype=bool)
        seen[:, self.start] = True
        step = np.zeros(n, dtype=np.int64)
        walking = np.arange(n) if k > 1 else np.arange(0)
        while len(walking):
            here, pos = at[walking], step[walking]
            # Distances are squared, so twice as far is four times; the quarter is rounded up to stay within a long.
            walking = walking[(self.between[here, pos] + 3) // 4 <= best[walking]]
            if not len(walking):
                break
            other = self.order[at[walking], step[walking]]
            step[walking] += 1
            new = ~seen[walking, other]
            who, which = walking[new], other[new]
            if len(who):
                seen[who, which] = True
                found = self._distance(queries[who], which)
                closer = (found < best[who]) | ((found == best[who]) & (which < at[who]))
                moved = who[closer]
                at[moved], best[moved], step[moved] = which[closer], found[closer], 0
            walking = walking[step[walking] < k - 1]
        return at, best


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _sums(rows: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Members and componentwise sum of every non-empty cluster: ``k`` rows on the driver."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        count, total = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(0), dims)
            for i in range(0, len(vectors), BATCH):
                part = vectors[i : i + BATCH]
                where, _ = search.nearest(part)
                count += np.bincount(where, minlength=k)
                np.add.at(total, where, part)
        full = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full), pa.array(count[full]), pa.array(total[full].tolist(), pa.list_(pa.int64()))],
            ["cluster", "n", "total"],
        )

    wide = "decimal(38,0)"
    parts = rows.select("v").mapInArrow(run, "cluster long, n long, total array<long>")
    sums = (
        parts.select("cluster", "n", F.posexplode("total").alias("i", "x")).groupBy("cluster", "i")
        .agg(F.sum("n").alias("n"), F.sum(F.col("x").cast(wide)).alias("x"))
        .groupBy("cluster").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("i", "x"))).alias("x"))
    )
    return {r["cluster"]: (r["n"], [int(e["x"]) for e in r["x"]]) for r in sums.collect()}


def cluster(
    vectors: DataFrame,
    k: int,
    dims: int,
    rounds: int = 5,
    seed: int = 2,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """``(vec_id, cluster, distance)`` per kept vector, and the final centroids.

    Integer k-means: ``rounds`` times all vectors are assigned and every
    non-empty centroid becomes the exact floor of its members' mean; then they
    are assigned once more. What reaches the driver or goes out to tasks is
    ``k`` vectors, however many rows there are. See :func:`integer_vectors`
    for the rows that are kept; with no row the result is empty and there are
    no centroids. Clashing names of other columns do no harm, as only id and
    vector are read.
    """
    rows = keep(integer_vectors(vectors, dims, scale, id_col, vector_col), "vectors")
    centroids = first_centroids(rows, k, seed).reshape(-1, dims)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = centroids.copy()
        for number, (n, total) in _sums(rows, centroids).items():
            centroids[number] = [x // n for x in total]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(centroids)
        for batch in batches:
            vectors = _matrix(batch.column(1), dims)
            found = [search.nearest(vectors[i : i + BATCH]) for i in range(0, max(1, len(vectors)), BATCH)]
            where, far = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(where.astype(np.int32)), pa.array(far)], ["vec_id", "cluster", "distance"]
            )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, cluster int, distance long"), centroids


def with_inertia(assigned: DataFrame) -> DataFrame:
    """``assigned`` with its distances summed per cluster and over all; a sum beyond a long counts as the largest long."""
    assigned = keep(assigned, "assigned")
    most = (1 << 63) - 1

    def held(total):
        return F.least(total, F.lit(most).cast("decimal(38,0)")).cast("long")

    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).cast("decimal(38,0)").alias("x"))
    per_cluster = keep(sums, "inertia")
    whole = per_cluster.agg(held(F.sum("x").cast("decimal(38,0)")).alias("inertia")).first()["inertia"]
    # One row per centroid: as small as the list of centroids that every task has.
    small = F.broadcast(per_cluster.select("cluster", held(F.col("x")).alias("cluster_inertia")))
    return assigned.join(small, "cluster").withColumn("inertia", F.lit(whole).cast("long"))

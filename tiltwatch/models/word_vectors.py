"""Word vectors from counted neighbours: every text is read twice, whatever the length of the training.

Skip-gram training takes one step per pair of neighbours and Huffman node, so its time
follows the words many times over. Its optimum depends on the pairs only through
how often each occurs (Levy and Goldberg, 2014): the vectors factorize the pairs' mutual information.
So the pairs are counted, and that matrix, bounded by the vocabulary, is factorized.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Word2Vec, Word2VecModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiltwatch.config import work_folder

# A count of neighbours stays below 2 to this power: it is ten times the words at most.
SHIFT = 40
# Words whose pairs a task counts at a time.
STEP = 1 << 20
# Directions followed besides those that are kept; they make the kept ones exact sooner.
SPARE = 16
# Neighbours weigh by their count to this power, as in the usual training with drawn non-neighbours: rare ones stand out less.
SMOOTHING = 0.75


def _slices(texts: pa.ListArray, step: int) -> Iterator[pa.ListArray]:
    """``texts`` in runs of ``step`` words or little more, as no text is cut."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(texts), 0).to_numpy(), dtype=np.int64)
    start = 0
    while start < len(texts):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + step, side="right")))
        yield texts.slice(start, stop - start)
        start = stop


def _pairs(
    word: np.ndarray, text: np.ndarray, start: int, step: int, size: int, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``a``, ``b`` and ``n`` of the pairs whose left word is one of ``step`` from ``start`` on."""
    key, filled = np.empty(window * min(step, len(word) - start), dtype=np.int64), 0
    for d in range(1, window + 1):
        stop = max(start, min(start + step, len(word) - d))
        x, y = word[start:stop], word[start + d : stop + d]
        same = text[start:stop] == text[start + d : stop + d]
        x, y = x[same], y[same]
        part = key[filled : filled + len(x)]
        part[:] = np.minimum(x, y)
        part *= size
        part += np.maximum(x, y)
        part *= window
        part += d - 1
        filled += len(x)
    key = key[:filled]
    key.sort()
    first = _starts(key)
    n = np.diff(first, append=filled)
    key = key[first]
    n *= window - key % window
    key //= window
    begin = _starts(key)
    n = np.add.reduceat(n, begin) if len(begin) else n
    a, b = np.divmod(key[begin], size)
    return a.astype(np.int32), b.astype(np.int32), n


def _starts(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    new = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return np.flatnonzero(new)


def neighbour_counts(tokens: DataFrame, words: list[str], window: int, step: int = STEP) -> DataFrame:
    """``(a, b, n)``: how often the words numbered ``a`` <= ``b`` are neighbours in the column ``token``.

    Words outside the vocabulary are left out first, as Word2Vec does. It draws a window of 1 to ``window``
    words at every word, so a pair ``d`` words apart falls into a share of 1 - (d - 1) / ``window`` of them.
    ``n`` adds up that share for every pair, times ``window``, which keeps it a whole number.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in _slices(batch.column(0), step):
                flat = texts.flatten()
                found = pc.index_in(flat, value_set=pa.array(words, flat.type))
                known = found.is_valid().to_numpy(zero_copy_only=False)
                lengths = pc.fill_null(pc.list_value_length(texts), 0).to_numpy()
                text = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)[known]
                word = found.drop_null().to_numpy()
                for start in range(0, len(word), step):
                    a, b, n = _pairs(word, text, start, step, len(words), window)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], ["a", "b", "n"])

    return tokens.select("token").mapInArrow(run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def neighbour_rows(counts: DataFrame) -> DataFrame:
    """``(a, x)`` with one row per word: its neighbours and their counts, each pair at both words.

    A row has as many entries as the vocabulary has words at most. An entry is one number, the neighbour's
    times 2^``SHIFT`` plus the count, so that they sort fast; their order makes later sums come out alike.
    """
    n = F.col("n")
    # A word beside itself is a neighbour from both sides.
    ends = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b", (n * 2).alias("n")))).otherwise(
        F.array(F.struct("a", "b", "n"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), "n"))
    )
    both = counts.select(F.explode(ends).alias("x")).select("x.a", (F.shiftleft(F.col("x.b").cast("long"), SHIFT) + F.col("x.n")).alias("x"))
    return both.groupBy("a").agg(F.sort_array(F.collect_list("x")).alias("x"))


def times(rows: DataFrame, totals: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The positive mutual information of all words with all neighbours, times the matrix ``right``.

    Both matrices have a row per word of the vocabulary; the tasks share out the rows of the first.
    """
    smooth = totals**SMOOTHING
    smooth = smooth / max(smooth.sum(), 1.0)
    near = right.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                b, n = np.divmod(x.values.to_numpy(), 1 << SHIFT)
                information = np.log(n / (totals[a] * smooth[b]))
                out.append((np.maximum(information, 0).astype(np.float32) @ near[b]).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["a", "y"])

    product = np.zeros(right.shape)
    for row in rows.mapInArrow(run, "a int, y binary").collect():
        product[row["a"]] = np.frombuffer(row["y"], np.float32)
    return product


def factorized(rows: DataFrame, size: int, dimensions: int, passes: int, seed: int) -> np.ndarray:
    """A vector per word: the leading directions of the mutual information, each times the root of its strength.

    ``passes`` rounds of block power iteration; every round reads ``rows`` once, and the driver
    holds ``dimensions`` + ``SPARE`` numbers per word. A word without neighbours has the zero vector.
    """
    totals = np.zeros(size)
    for row in rows.select("a", F.aggregate("x", F.lit(0).cast("long"), lambda n, x: n + x.bitwiseAND((1 << SHIFT) - 1)).alias("n")).collect():
        totals[row["a"]] = row["n"]
    basis = np.random.default_rng(seed).standard_normal((size, min(size, dimensions + SPARE)))
    for _ in range(passes):
        basis, _ = np.linalg.qr(times(rows, totals, basis))
    inner = basis.T @ times(rows, totals, basis)
    strength, turn = np.linalg.eigh((inner + inner.T) / 2)
    order = np.argsort(-np.abs(strength), kind="stable")[:dimensions]
    vectors = np.zeros((size, dimensions))
    vectors[:, : len(order)] = (basis @ turn[:, order]) * np.sqrt(np.abs(strength[order]))
    vectors[totals == 0] = 0  # else what rounding leaves
    return vectors


def word_model(tokens: DataFrame, words: list[str], vectors: np.ndarray, **params) -> Word2VecModel:
    """A Word2VecModel with the given vectors: it is saved without training, given the vectors' file, and loaded."""
    spark = tokens.sparkSession
    listed = spark.createDataFrame([(words,)], "token array<string>")
    plain = Word2Vec(vectorSize=vectors.shape[1], minCount=1, maxIter=0, **params).fit(listed)
    folder = work_folder(spark, "word-vectors")
    plain.save(folder)
    rows = spark.createDataFrame(list(zip(words, vectors.tolist())), "word string, vector array<float>")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{folder}/data")
    return Word2VecModel.load(folder)

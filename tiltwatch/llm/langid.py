"""Language identification by error-correcting output codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiltwatch.llm.common import drawn, learnable

#: Hash buckets for each length of character n-grams.
BUCKETS = 4096
ORDERS = (1, 2, 3)
UNKNOWN = "und"


#: Which of the first 65,536 code points are letters.
_LETTERS = np.fromiter((chr(i).isalpha() for i in range(0x10000)), dtype=bool, count=0x10000)


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the text's hashed character n-grams, by length; None without a letter.

    The whole text is lower-cased; whatever is no letter parts words.
    """
    if not text:
        return None
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    is_letter = _LETTERS[np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        found, back = np.unique(points[high], return_inverse=True)
        is_letter[high] = np.array([chr(x).isalpha() for x in found])[back]
    if not is_letter.any():
        return None
    marks = np.where(is_letter, points, 32).astype(np.uint64)
    kept = np.ones(len(marks), dtype=bool)
    kept[1:] = is_letter[1:] | is_letter[:-1]
    marks = np.concatenate([[np.uint64(32)], marks[kept], [np.uint64(32)]])
    counts = np.zeros((len(ORDERS), BUCKETS))
    rolled = np.zeros(len(marks), dtype=np.uint64)
    for k, n in enumerate(ORDERS):
        rolled = rolled[: len(marks) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + marks[n - 1 :]
        mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        counts[k] = np.bincount((mixed >> np.uint64(52)).astype(np.int64), minlength=BUCKETS)
    return counts.ravel()


def codewords(n: int) -> np.ndarray:
    """One row of +1 and -1 bits per class, any two rows far apart.

    Up to five classes get every two-way split of them; more get the best of
    a hundred seeded draws of about fifteen bits per doubling.
    """
    if n < 2:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 5:
        splits = range(1, 1 << max(0, n - 1))
        bits = [[1 if not i or not (s >> (i - 1)) & 1 else -1 for s in splits] for i in range(n)]
        return np.array(bits, dtype=np.int8)
    draw, width = np.random.default_rng(7), 15 * int(np.ceil(np.log2(n)))
    best, apart = None, -1
    for _ in range(100):
        code = draw.choice(np.array([-1, 1], dtype=np.int8), size=(n, width))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        nearest = min(int((code[i] != code[i + 1 :]).sum(axis=1).min()) for i in range(n - 1))
        if nearest > apart:
            best, apart = code, nearest
    return best


@dataclass
class LanguageModel:
    """Classes, their codewords, a linear n-gram classifier per bit and its reliability."""

    classes: list[str]
    code: np.ndarray
    weights: np.ndarray  # n-gram buckets x bits
    trust: np.ndarray  # classes x bits: how often the bit came out right for the class

    def margins(self, counts: np.ndarray) -> np.ndarray:
        """Signed evidence for each bit. N-grams overlap, so their log-odds count in part."""
        return counts @ self.weights / len(ORDERS) / 4

    def decide(self, counts: np.ndarray | None) -> tuple[str, float, bool]:
        """Class, score and whether the second-best codeword comes close."""
        if counts is None or not self.classes:
            return UNKNOWN, 0.0, True
        if len(self.classes) == 1:
            return self.classes[0], 1.0, False
        loss = np.logaddexp(0, -self.code * self.margins(counts))
        total = (self.trust * loss).sum(axis=1)
        likely = np.exp(-(total - total.min()))
        likely /= likely.sum()
        order = np.argsort(-likely, kind="stable")
        best, second = likely[order[0]], likely[order[1]]
        return self.classes[order[0]], float(min(1.0, best)), bool(second > 0.5 * best)


def _counting(most_letters: int):
    """Per language and part of a task's rows, the summed counts and, last, the number of documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, bool], np.ndarray] = {}
        for batch in batches:
            for lang, checks, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (counts := gram_counts(text.as_py())) is None:
                    continue
                held = sums.setdefault((lang, checks), np.zeros(len(counts) + 1))
                held[:-1] += counts * min(1.0, most_letters / counts[:BUCKETS].sum())
                held[-1] += 1
        for (lang, checks), held in sums.items():
            at = np.nonzero(held)[0]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array([checks] * len(at)),
                 pa.array(at.astype(np.int32)), pa.array(held[at])],
                ["lang", "checks", "bucket", "n"],
            )

    return counted


def _weights(counts: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Log-odds of the mean distributions of a bit's two sides, for every n-gram and bit."""
    n = len(counts)
    by_order = counts.reshape(n, len(ORDERS), BUCKETS) + 0.5
    shares = (by_order / by_order.sum(axis=2, keepdims=True)).reshape(counts.shape)
    weights = np.zeros((counts.shape[1], code.shape[1]))
    for b in range(code.shape[1] if n > 1 else 0):
        one, two = (shares[side].mean(axis=0) for side in (code[:, b] > 0, code[:, b] < 0))
        weights[:, b] = np.log(one / two)
    return weights


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang",
    check_rows: int = 5000, most_letters: int = 2000, most_classes: int = 500,
) -> LanguageModel:
    """Learn from every labelled row that is not held out.

    Tasks sum n-gram counts per language and Spark adds them up, so the driver
    gets classes times buckets numbers, however many rows there are: the
    ``most_classes`` labels of most documents are learned, ties going to the
    first in code-point order. A document of more than ``most_letters`` letters weighs
    like one of so many, all of it counted. A bit's classifier is the log-odds
    of the mean distributions of its two sides. How far each bit can be
    trusted is measured on about ``check_rows`` rows, a fifth of all at most,
    drawn by a hash of their id, by classifiers that have not seen these; the final ones have.

    Rows whose id, label or text is NULL, or whose text has no letter, teach
    nothing. Without any other the model has no classes and answers ``und``;
    repeated rows count repeatedly; other columns are not read.
    """
    rows = docs.filter(learnable(F.col(id_col)) & F.col(label_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(label_col).alias("lang"), F.col(text_col).alias("text")
    )
    sizes = rows.groupBy("lang").count()
    total = sizes.agg(F.sum("count")).first()[0] or 1
    named = sorted(r["lang"] for r in sizes.orderBy(F.desc("count"), "lang").limit(most_classes).collect())
    rows = rows.filter(F.col("lang").isin(named)).withColumn(
        "checks", drawn("trust", F.col("id"), min(0.2, check_rows / total))
    )
    parts = rows.select("lang", "checks", "text").mapInArrow(
        _counting(most_letters), "lang string, checks boolean, bucket int, n double"
    )
    table = parts.groupBy("lang", "checks", "bucket").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    classes = sorted(set(table["lang"]))
    size = len(ORDERS) * BUCKETS
    counts = np.zeros((2, len(classes), size))
    place = {c: i for i, c in enumerate(classes)}
    for lang, checks, bucket, n in zip(*(table[c] for c in ("lang", "checks", "bucket", "n"))):
        if bucket < size:
            counts[int(checks), place[lang], bucket] = round(n, 6)
    code = codewords(len(classes))
    model = LanguageModel(classes, code, _weights(counts[0], code), np.ones(code.shape))
    if len(classes) > 1:
        model.trust = _trust(rows.filter("checks"), model)
    model.weights = _weights(counts.sum(axis=0), code)
    return model


def _trust(rows: DataFrame, model: LanguageModel) -> np.ndarray:
    """Per class and bit, how often the bit is right on these rows; a class sums to its number of bits."""

    def right(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits = np.zeros((len(model.classes), model.code.shape[1] + 1))
        place = {c: i for i, c in enumerate(model.classes)}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if lang in place and (counts := gram_counts(text.as_py())) is not None:
                    agree = model.code[place[lang]] * model.margins(counts) > 0
                    hits[place[lang]] += np.append(agree, 1)
        at = np.nonzero(hits.ravel())[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(hits.ravel()[at])], ["at", "n"]
        )

    found = rows.select("lang", "text").mapInArrow(right, "at int, n double")
    hits = np.zeros((len(model.classes), model.code.shape[1] + 1))
    for row in found.groupBy("at").agg(F.sum("n").alias("n")).collect():  # classes x bits
        hits.ravel()[row["at"]] = row["n"]
    trust = (hits[:, :-1] + 1) / (hits[:, -1:] + 2)
    return trust / trust.sum(axis=1, keepdims=True) * model.code.shape[1]


def identify(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All columns of ``docs`` and ``_lang``, ``_score``, ``_ambiguous``; those names are replaced.

    Binary classifiers over the n-grams of the whole text predict the bits of
    a codeword; the class with the least loss, each bit weighted by its
    reliability for the class, wins. A row is ambiguous if the second-best
    class is over half as likely, or there is none. Text that is NULL or has
    no letter is ``und`` with score 0. Ids and labels are not looked at.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.decide(gram_counts(t.as_py())) for t in batch.column(text_col)]
            extra = [
                pa.array([x[0] for x in found], pa.string()),
                pa.array([x[1] for x in found], pa.float64()),
                pa.array([x[2] for x in found], pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names)

    data = docs.drop("_lang", "_score", "_ambiguous")
    names = [*data.columns, "_lang", "_score", "_ambiguous"]
    schema = data.withColumns({
        "_lang": F.lit("").cast("string"), "_score": F.lit(0.0), "_ambiguous": F.lit(False)
    }).schema
    return data.mapInArrow(run, schema)

"""Quality rules on repetition: characters inside duplicated n-grams and lines."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiltwatch.llm.common import WORD_CLASS  # noqa: F401  the words that split() below gives

#: Share of a text's word characters that duplicated n-grams of each length may cover.
LIMITS = {5: 0.50, 6: 0.48, 7: 0.46, 8: 0.44, 9: 0.42, 10: 0.40}
#: Share of a text's word characters that may lie in lines seen before.
LINE_LIMIT = 0.30
_SPACES = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:]] = same
    twice[order[:-1]] |= same
    return twice


def _inside(windows: np.ndarray, n: int, n_words: int) -> np.ndarray:
    """Which words lie in a marked window of ``n`` words."""
    edges = np.zeros(n_words + 1, dtype=np.int64)
    at = np.nonzero(windows)[0]
    edges[at] += 1
    edges[at + n] -= 1
    return np.cumsum(edges[:-1]) > 0


def _spread(ids: np.ndarray) -> np.ndarray:
    """A 64-bit value for each word number, alike for equal words."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * _BASE
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def measure(text: str | None, lengths: tuple[int, ...] = tuple(LIMITS)) -> dict:
    """Counts and coverages of one whole text; see :func:`repetition`."""
    text = text or ""
    # bytes.split parts words at the six ASCII spaces only.
    words = [w.decode("utf-8", "surrogatepass") for w in text.encode("utf-8", "surrogatepass").split()]
    n = len(words)
    out = {
        "n_words": n,
        "word_chars": len(text) - sum(text.count(c) for c in _SPACES),
        "n_symbols": sum(text.count(c) for c in _SYMBOLS),
        "n_dup_lines": 0,
        "n_repeat_words": 0,
        "dup_line_chars": 0,
        "coverage": {k: 0 for k in lengths},
    }
    if not n:
        return out
    seen: set[str] = set()
    for line in text.split("\n"):
        if line in seen:
            if chars := len(line) - sum(line.count(c) for c in _SPACES):
                out["n_dup_lines"] += 1
                out["dup_line_chars"] += chars
        else:
            seen.add(line)
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=n)
    chars = np.fromiter(map(len, words), dtype=np.int64, count=n)
    if n >= 3:
        # Exact: equal pairs get one number, then pairs with the next word.
        _, pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)
        twice = _repeated(pairs[:-1] * len(numbers) + ids[2:])
        out["n_repeat_words"] = int(_inside(twice, 3, n).sum())
    values = _spread(ids)
    # Horner's rule, word by word: a window's hash grows from the one before.
    rolled, width = values, 1
    for k in sorted(lengths):
        if n < k:
            break
        while width < k:
            rolled = rolled[:-1] * _BASE + values[width:]
            width += 1
        twice = _repeated(rolled)
        if not twice.any():
            break  # no longer window can be repeated either
        out["coverage"][k] = int(chars[_inside(twice, k, n)].sum())
    return out


def repetition(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limits: dict[int, float] | None = None,
    line_limit: float = LINE_LIMIT,
) -> DataFrame:
    """Per row: counts, ``coverage`` by n-gram length, ``dup_line_chars`` and ``repetitive``.

    Rolling hashes of the whole text's words find the n-grams of each length
    that occur twice or more; coverage counts the characters of the words they
    cover, the first occurrence included, each once. ``repetitive`` is true
    where a coverage or the characters of lines seen before exceed their share
    of all word characters.

    NULL and empty texts count zero everywhere and are not repetitive.
    Repeated rows each get a row; NULL ids are carried along. Other columns
    are not read; an empty table gives an empty result.
    """
    bounds = dict(sorted((LIMITS if limits is None else limits).items()))
    lengths = tuple(bounds)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [measure(t.as_py(), lengths) for t in batch.column(1)]
            columns = [pa.array([x[c] for x in found], pa.int64()) for c in counts]
            cover = pa.array([list(x["coverage"].items()) for x in found], pa.map_(pa.int32(), pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, cover], ["doc_id", *counts, "coverage"]
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, {', '.join(f'{c} long' for c in counts)}, coverage map<int,long>"
    over = F.col("dup_line_chars") > line_limit * F.col("word_chars")
    for k, limit in bounds.items():
        over = over | (F.col("coverage")[k] > limit * F.col("word_chars"))
    return rows.mapInArrow(run, schema).withColumn("repetitive", over)

"""Benchmark items found inside documents by containment sketches and exact shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiltwatch.llm.common import keep

SHINGLE = 5
THRESHOLD = 0.8
#: A shingle that many documents share is dealt over so many groups for the exact check.
SALTS = 16


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits; punctuation and layout part words."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _windows(rows: DataFrame, words: str, width: int) -> DataFrame:
    """One row per window of ``width`` neighbouring words: ``h`` and ``shingle``."""
    shifted = [F.slice(words, i + 1, F.greatest(F.size(words), F.lit(1))).alias(f"w{i}") for i in range(width)]
    parts = [F.col(f"w.w{i}") for i in range(width)]
    return (
        rows.withColumn("w", F.explode(F.arrays_zip(*shifted)))
        .filter(parts[-1].isNotNull())
        .withColumns({"h": F.xxhash64(*parts), "shingle": F.concat_ws(" ", *parts)})
        .drop("w", words)
    )


def _items(benchmark: DataFrame, item_col: str, text_col: str, shingle: int) -> DataFrame:
    """Distinct shingles of every item: ``item_key, item_id, width, h, shingle, n``."""
    items = benchmark.select(
        F.col(item_col).alias("item_id"),
        F.xxhash64(F.col(item_col), F.col(text_col)).alias("item_key"),
        words_of(F.col(text_col)).alias("words"),
    ).distinct()
    items = items.withColumn("width", F.least(F.lit(shingle), F.size("words"))).filter("width > 0")
    found = None
    for width in range(1, shingle + 1):
        part = _windows(items.filter(F.col("width") == width), "words", width).distinct()
        found = part if found is None else found.unionAll(part)
    return found.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("item_key")))


def sketches(items: DataFrame, threshold: float) -> DataFrame:
    """The least shingle hashes of every item, as many as its size class needs.

    Items are partitioned by size into classes of one doubling each. Of an
    item's n shingles a document that holds the share ``threshold`` lacks at
    most n - ceil(threshold n); one more than that many of its least hashes
    are sure to include one the document has. The number is taken at the
    class's upper bound, so it is never short.
    """
    upper = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n").cast("double"))))
    needed = upper - F.ceil(upper * threshold - 1e-9) + 1
    place = F.row_number().over(Window.partitionBy("item_key").orderBy("h"))
    return items.withColumn("place", place).filter(F.col("place") <= needed).drop("place")


def contained_items(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
) -> DataFrame:
    """``doc_id, text_hash, item_id, n_shingles, n_found, containment`` of items inside documents.

    Candidates: a document's shingles are compared with the items' MinHash
    sketches, of a size set per size class (see :func:`sketches`), so a short
    item is found however long the document. Candidates are then verified by
    the exact share of the item's distinct shingles that the document holds.

    Words are lower-cased runs of letters and digits. An item shorter than
    ``shingle`` words is one shingle, looked for among document windows of its
    own length; items without words, NULL or empty texts find nothing. Rows
    that agree in id and text give one result; ids may be NULL; an item listed
    twice alike counts once. Empty tables give an empty result. Other columns
    are not read.
    """
    items = keep(_items(benchmark, item_col, item_text_col, shingle), "items")
    sketch = keep(sketches(items, threshold).select("width", "h", "item_key"), "sketches")
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most `shingle`
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(text_col)).alias("text_hash"),
                       F.col(text_col).alias("text"))

    def windows(some: DataFrame) -> DataFrame:
        worded = some.withColumn("words", words_of(F.col("text"))).drop("text")
        parts = [_windows(worded, "words", w).withColumn("width", F.lit(w)) for w in widths]
        return _union(parts) if parts else worded.select(
            "doc_id", "text_hash", F.lit(0).cast("long").alias("h"), F.lit("").alias("shingle"),
            F.lit(0).alias("width"),
        ).limit(0)

    candidates = keep(
        windows(rows).drop("shingle").join(sketch, ["width", "h"])
        .select("doc_id", "text_hash", "item_key").distinct(),
        "candidates",
    )
    # Only documents with a candidate are read again; equal rows once.
    hit = candidates.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash")).distinct()
    again = rows.join(
        hit, (F.col("text_hash") == F.col("c_hash")) & F.col("doc_id").eqNullSafe(F.col("c_id")), "left_semi"
    )
    # Items, few beside the documents, are repeated per group; a merge join, as the
    # repeated items are larger than the planner takes them for.
    salted = items.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    matched = (
        windows(again)
        .withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(SALTS)).cast("int"))
        .join(salted, ["width", "h", "shingle", "salt"])
        .groupBy("doc_id", "text_hash", "item_key", "item_id", "n", "h", "shingle")
        .agg(F.lit(1))
        .groupBy("doc_id", "text_hash", "item_key", "item_id", "n")
        .agg(F.count(F.lit(1)).alias("found"))
        .filter(F.col("found") >= F.col("n") * threshold - 1e-9)
    )
    c = candidates.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"),
                          F.col("item_key").alias("c_item"))
    return matched.join(
        c,
        (F.col("text_hash") == F.col("c_hash")) & (F.col("item_key") == F.col("c_item"))
        & F.col("doc_id").eqNullSafe(F.col("c_id")),
        "left_semi",
    ).select(
        "doc_id", "text_hash", "item_id", F.col("n").alias("n_shingles"), F.col("found").alias("n_found"),
        (F.col("found") / F.col("n")).alias("containment"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """``docs`` without those that hold a benchmark item, all columns as they were."""
    found = contained_items(docs, benchmark, id_col, text_col, **options)
    bad = keep(found.select(F.col("doc_id").alias("__bad_id"), F.col("text_hash").alias("__bad_hash")).distinct(),
               "contaminated")
    return docs.join(
        bad,
        (F.xxhash64(F.col(f"`{text_col}`")) == F.col("__bad_hash"))
        & F.col(f"`{id_col}`").eqNullSafe(F.col("__bad_id")),
        "left_anti",
    )

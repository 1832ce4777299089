"""Passages that documents share: paragraph MinHash banding, exact checks, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiltwatch.llm.common import keep
from tiltwatch.llm.components import components

SHINGLE = 5
THRESHOLD = 0.8
SEED = 42
#: Paragraphs below this many words are left alone, unless asked otherwise; pieces of longer ones have as many.
PIECE = 20
#: Every run of 50 words holds a whole piece: an anchor lies in each stretch of so many shingles.
STRETCH = 31
#: Paragraphs of a band meet in chunks of about this many, and of about so many code points.
CHUNK, CHUNK_SIZE = 256, 1 << 18
#: Columns of the shingle table that are multiplied at a time.
WIDTH = 4096
#: Hash slots that tell which rows a join may need.
SLOTS = 1 << 21
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tune_bands(
    threshold: float = THRESHOLD, recall: float = 0.98, most: int = 128, chance: float = 0.4, weight: float = 9.0
) -> tuple[int, int]:
    """``(bands, rows)`` of least cost that find a pair at ``threshold`` with probability ``recall``.

    A pair of similarity s shares a band with probability 1 - (1 - s^r)^b. A
    band costs one row to shuffle for each paragraph, and ``weight`` times the share of pairs of
    similarity ``chance``, as between paragraphs made from one form, that it brings together for nothing:
    few short bands move little but fill with such pairs.
    """
    fitting = [
        (b * (1 + weight * chance**r), b, r)
        for r in range(2, most + 1)
        for b in range(1, most // r + 1)
        if 1 - (1 - threshold**r) ** b >= recall
    ]
    return min(fitting)[1:]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shingles(values: np.ndarray, size: int) -> np.ndarray:
    """Rolling hash of every ``size`` neighbouring word values; of all, if there are fewer."""
    size = min(size, len(values))
    rolled = values
    for k in range(1, size):
        rolled = rolled[:-1] * _BASE + values[k:]
    return _mix(rolled)


def _anchors(hashes: np.ndarray) -> np.ndarray:
    """Positions that are the least of some stretch of ``STRETCH`` hashes."""
    found = []
    for at in range(0, max(1, len(hashes) - STRETCH + 1), 1 << 15):
        part = hashes[at : at + (1 << 15) + STRETCH - 1]
        if len(part) >= STRETCH:
            views = np.lib.stride_tricks.sliding_window_view(part, STRETCH)
            found.append(np.unique(views.argmin(axis=1) + np.arange(len(views))) + at)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.int64)


def units(
    text: str | None, bands: int, rows: int, min_words: int = PIECE
) -> list[tuple[int, int, int, int, list[int] | None]]:
    """``(hash, check, start, end, bands)`` of a text's paragraphs and, without bands, its pieces.

    Offsets are code points. The hash and, for pieces, a second one tell texts
    apart. A paragraph is a line of ``min_words`` words or more;
    a piece is the ``PIECE`` words from an anchor, wherever lines end. Anchors
    depend only on the words around them, so a passage has the same pieces in
    every document that holds it.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    if len(words) < min(PIECE, min_words):
        return []
    codes = np.frombuffer(raw, dtype=np.uint8)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    turns = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    first, last = turns[::2], turns[1::2]
    # Code points that begin before each byte.
    points = np.concatenate([[0], np.cumsum((codes & 0xC0) != 0x80)])
    digest = xxhash.xxh64_intdigest
    values = np.fromiter(map(digest, words, repeat(SEED)), dtype=np.uint64, count=len(words))
    hashes = _shingles(values, SHINGLE)
    found = []
    for at in _anchors(hashes).tolist():
        if at + PIECE <= len(words):
            unit = xxhash.xxh3_128_intdigest(b" ".join(words[at : at + PIECE]), SEED)
            found.append((unit >> 64, unit & 0xFFFFFFFFFFFFFFFF, int(points[first[at]]), int(points[last[at + PIECE - 1]]), None))
    breaks = np.flatnonzero(codes == 10)
    edges = np.unique(np.concatenate([[0], np.searchsorted(first, breaks), [len(words)]]))
    long = np.flatnonzero(np.diff(edges) >= min_words)
    if not len(long):
        return found
    begin, end = edges[long], edges[long + 1]
    # Each line's own shingles: from its first word to the last that starts one within it.
    cuts = np.minimum(np.stack([begin, np.maximum(end - SHINGLE, begin) + 1], axis=1).ravel(), len(hashes))
    # Half of the hash bits order shingles as well as all, at half the time.
    factors = (_mix(np.arange(1, bands * rows + 1, dtype=np.uint64) * _BASE) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    padded = np.append(hashes >> np.uint64(32), np.uint64(0)).astype(np.uint32)
    turned = np.empty_like(padded)
    least = np.empty((bands * rows, len(long)), dtype=np.uint64)
    for i, f in enumerate(factors):
        np.multiply(padded, f, out=turned)
        least[i] = np.minimum.reduceat(turned, cuts)[::2]
    least = least.reshape(bands, rows, len(long))
    keys = least[:, 0, :]
    for k in range(1, rows):
        keys = keys * _BASE + least[:, k, :]
    keys = _mix(keys + (np.arange(bands, dtype=np.uint64) * _BASE)[:, None]).view(np.int64).T.tolist()
    for a, b, key in zip(begin.tolist(), end.tolist(), keys):
        line = raw[first[a] : last[b - 1]]
        found.append((digest(line, SEED), 0, int(points[first[a]]), int(points[last[b - 1]]), key))
    return found


def _line_shingles(line: str) -> np.ndarray:
    """The distinct shingles of a line, as hashes of hashes of its words."""
    words = line.encode("utf-8", "surrogatepass").lower().split()
    values = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), dtype=np.uint64, count=len(words))
    return np.unique(_shingles(values, SHINGLE))


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two lines share: products of the table of lines and shingles, some columns at a time."""
    names, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for at in range(0, len(names), WIDTH):
        low, high = np.searchsorted(column, [at, at + WIDTH])
        table = np.zeros((len(sets), min(WIDTH, len(names) - at)), dtype=np.float32)
        table[row[low:high], column[low:high] - at] = 1
        shared += table @ table.T
    return shared


def verified(
    left: list[tuple[int, str]], right: list[tuple[int, str]] | None, threshold: float
) -> list[tuple[int, int]]:
    """Edges that join exactly the similar lines of two chunks, one per joined line.

    Jaccard similarities are exact and taken for all pairs at once; of the
    pairs that reach ``threshold`` those are left out that earlier edges have joined already.
    """
    nodes = left + (right or [])
    sets = [_line_shingles(line) for _, line in nodes]
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    shared = _shared(sets)
    close = shared >= threshold * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
    close = np.triu(close, 1)
    if right is not None:
        close[:, : len(left)] = False
        close[len(left) :] = False
    top = list(range(len(nodes)))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = i = top[top[i]]
        return i

    edges = []
    for i, j in np.argwhere(close).tolist():
        if nodes[i][0] != nodes[j][0] and (x := find(i)) != (y := find(j)):
            top[x] = y
            edges.append((nodes[i][0], nodes[j][0]))
    return edges


def _thinned(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` less most of those whose hash ``key`` is not among ``wanted``, before a join on it.

    The hash slots of the wanted keys are at most ``SLOTS`` rows, so safe to
    broadcast; rows in no such slot never move.
    """
    slot = F.pmod(key, F.lit(SLOTS)).cast("int").alias("slot")
    slots = F.broadcast(wanted.select(slot).distinct())
    return rows.withColumn("slot", slot).join(slots, "slot", "left_semi").drop("slot")


def _similar_lines(lines: DataFrame, text_of: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)`` edges between distinct lines that share a band and are similar."""
    banded = lines.select("unit", "size", F.explode("bands").alias("band"))
    # A line may be a whole document, so chunks are filled by size as well as by number.
    chunks = F.ceil(F.greatest(F.col("n") / CHUNK, F.least(F.col("size") / CHUNK_SIZE, F.col("n"))))
    full = keep(
        banded.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).filter("n > 1")
        .select("band", chunks.cast("int").alias("chunks")),
        "bands",
    )
    members = keep(
        _thinned(banded, "band", full).join(full, "band").select(
            "band", "unit", "chunks", F.pmod(F.xxhash64("unit"), "chunks").cast("int").alias("chunk")
        ),
        "band-members",
    )
    wanted = keep(members.select("unit").distinct(), "lines-wanted")
    texts = keep(
        _thinned(text_of, "unit", wanted).join(wanted, "unit", "left_semi")
        .groupBy("unit").agg(F.min("line").alias("line")),
        "lines",
    )
    packs = keep(
        members.join(texts, "unit").groupBy("band", "chunk").agg(
            F.max("chunks").alias("chunks"), F.collect_list(F.struct("unit", "line")).alias("lines")
        ),
        "band-chunks",
    )
    left = packs.select(
        "band", F.col("chunk").alias("chunk_a"), F.col("lines").alias("lines_a"),
        F.explode(F.sequence(F.lit(0), F.col("chunk"))).alias("chunk"),
    )
    pairs = left.join(packs.drop("chunks"), ["band", "chunk"]).select(
        "lines_a", F.when(F.col("chunk") != F.col("chunk_a"), F.col("lines")).alias("lines_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = []
            for a, b in zip(batch.column(0), batch.column(1)):
                sides = [[(x["unit"], x["line"]) for x in s.as_py()] if s.is_valid else None for s in (a, b)]
                edges += verified(sides[0], sides[1], threshold)
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    return pairs.mapInArrow(run, "a long, b long")


def line_classes(found: DataFrame, docs: DataFrame, text_col: str, threshold: float) -> DataFrame:
    """``(unit, low, high, component_id)`` of every distinct paragraph among the units ``found`` in ``docs``.

    ``component_id`` is the least paragraph that verified similarities reach;
    low and high are the least and greatest document with the paragraph.
    """
    lines = keep(
        found.filter("bands IS NOT NULL").groupBy("unit").agg(
            F.min("doc").alias("low"), F.max("doc").alias("high"), F.first("bands").alias("bands"),
            F.max(F.col("end") - F.col("start")).alias("size"),
        ),
        "paragraphs",
    )
    # The same lines once more as text; their hash is Spark's own xxhash64.
    text_of = docs.select(F.explode(F.split(F.col(f"`{text_col}`"), "\n")).alias("line")).select(
        F.regexp_replace("line", r"\A[\x20\x09-\x0D]+|[\x20\x09-\x0D]+\z", "").alias("line")
    ).withColumn("unit", F.xxhash64("line"))
    linked = components(_similar_lines(lines, text_of, threshold))
    return lines.join(linked.withColumnRenamed("node", "unit"), "unit", "left").select(
        "unit", "low", "high", F.coalesce("root", "unit").alias("component_id")
    )


def found_units(
    docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int, min_words: int = PIECE
) -> DataFrame:
    """The :func:`units` of every row, with ``doc``, a hash that tells rows of one id and text from others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(i, u) for i, t in enumerate(batch.column(2)) for u in units(t.as_py(), bands, rows, min_words)]
            at = pa.array([i for i, _ in found], pa.int32())
            unit, check = (np.array([u[k] for _, u in found], dtype=np.uint64).view(np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at), batch.column(1).take(at), pa.array(unit), pa.array(check),
                    pa.array([u[2] for _, u in found], pa.int32()), pa.array([u[3] for _, u in found], pa.int32()),
                    pa.array([u[4] for _, u in found], pa.list_(pa.int64())),
                ],
                ["doc_id", "doc", "unit", "check", "start", "end", "bands"],
            )

    text = F.col(f"`{text_col}`")
    rows_in = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.col(f"`{id_col}`"), text).alias("doc"), text.alias("text")
    )
    kind = rows_in.schema["doc_id"].dataType.simpleString()
    return rows_in.mapInArrow(
        run, f"doc_id {kind}, doc long, unit long, check long, start int, end int, bands array<long>"
    )


def shared_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
    recall: float = 0.98, min_words: int = PIECE,
) -> DataFrame:
    """``doc_id, start, end, component_id, kept``: passages found in several documents.

    Paragraphs (lines of ``min_words`` words or more; shorter ones are out of scope) are compared by MinHash bands over
    five-word shingles, tuned for ``recall`` at ``threshold``; those that
    share a band are verified by exact Jaccard similarity, and components of
    similar paragraphs are one cluster. A passage inside longer paragraphs is
    found by its pieces, 20 words from anchors that its own words set; any 50
    neighbouring words hold one. Equal paragraphs and pieces meet as one class
    before anything is compared, pieces by 128 bits of hash.

    Of every cluster or class seen in two documents or more, the occurrence
    with the least id and offset is kept, the others are for removal.
    Overlapping and touching occurrences of a document with the same ``kept``
    are joined; ``component_id`` is then the least among them. Offsets are code
    points, the end exclusive.

    NULL, empty and short texts have no passages. Rows that agree in id and
    text count as one document, NULL ids included, and each gets its rows.
    Other columns are not read; an empty table gives an empty result.
    """
    bands, rows = tune_bands(threshold, recall)
    found = keep(found_units(docs, id_col, text_col, bands, rows, min_words), "units")
    pieces = (
        found.filter("bands IS NULL").groupBy("unit", "check")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low != high")
        .select("unit", "check", F.lit(False).alias("line"), F.col("unit").alias("component_id"))
    )
    rooted = line_classes(found, docs, text_col, threshold)
    clusters = rooted.groupBy("component_id").agg(
        F.min("low").alias("low"), F.max("high").alias("high")
    ).filter("low != high").select("component_id")
    lines_hit = rooted.select("unit", "component_id").join(clusters, "component_id").select(
        "unit", F.lit(0).cast("long").alias("check"), F.lit(True).alias("line"), "component_id"
    )
    hit = keep(pieces.unionAll(lines_hit), "shared")
    spans = keep(
        found.withColumn("line", F.col("bands").isNotNull()).drop("bands")
        .join(hit, ["unit", "check", "line"]).drop("unit", "check"),
        "occurrences",
    )
    firsts = keep(
        spans.groupBy("component_id", "line").agg(F.min(F.struct("doc_id", "start", "end", "doc")).alias("first")),
        "first-occurrences",
    )
    kept = (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("start") == F.col("first.start")) & (F.col("doc") == F.col("first.doc"))
    )
    spans = spans.join(firsts, ["component_id", "line"]).select(
        "doc_id", "doc", "start", "end", "component_id", kept.alias("kept")
    )
    order = Window.partitionBy("doc_id", "doc", "kept").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(before >= F.col("start") - 1, 0).otherwise(1)).over(order)
    return (
        spans.withColumn("island", island)
        .groupBy("doc_id", "doc", "kept", "island")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("component_id").alias("component_id"))
        .select("doc_id", "start", "end", "component_id", "kept")
    )

"""Near-duplicate documents by SimHash fingerprints compared tile against tile."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiltwatch.llm.common import keep
from tiltwatch.llm.components import components

SEED = 42
#: A fingerprint's 64 bits are counted in so many parts; a tile is one combination of counts.
PARTS = 4
#: Fingerprints of a tile are compared in chunks of about this many.
CHUNK = 4096


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of the lower-cased text: a bit is set if over half of the shingle hashes set it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter(
        (digest(join(x), SEED) for x in zip(*(words[i:] for i in range(shingle)))),
        dtype="<u8",
        count=len(words) - shingle + 1,
    )
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)``, the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in texts), dtype=np.uint64, count=len(texts)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"]
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, fp long")


def _steps(radius: int) -> list[int]:
    """Differences of tile numbers whose counts differ by ``radius`` in all, one per direction.

    A tile number holds the counts of the parts in fields of eight bits, so a
    step out of 0..64 reaches a number that no tile has.
    """
    steps = {(0,) * PARTS}
    for _ in range(radius):
        steps |= {s[:i] + (s[i] + d,) + s[i + 1 :] for s in steps for i in range(PARTS) for d in (-1, 1)}
    numbers = {sum(x << (8 * i) for i, x in enumerate(s)) for s in steps}
    return sorted(n for n in numbers if n >= 0)


def _merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least label of each component after adding the links ``i``-``j``."""
    while len(i):
        x, y = labels[i], labels[j]
        open_ = x != y
        if not open_.any():
            break
        i, j, x, y = i[open_], j[open_], x[open_], y[open_]
        low = np.minimum(x, y)
        np.minimum.at(labels, np.maximum(x, y), low)
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels = up
    return labels


def tile_links(a: np.ndarray, b: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest over the fingerprints of two chunks with the components that links give.

    All pairs are compared; ``b`` of None compares ``a`` with itself. Only one
    edge per joined fingerprint is returned, not every link.
    """
    other = a if b is None else b
    shift = 0 if b is None else len(a)
    labels = np.arange(len(a) + (0 if b is None else len(b)))
    rows = max(1, (1 << 20) // max(1, len(other)))
    for at in range(0, len(a), rows):
        near = np.bitwise_count(a[at : at + rows, None] ^ other[None, :]) <= radius
        i, j = np.nonzero(near)
        i += at
        if b is None:
            i, j = i[i < j], j[i < j]
        labels = _merge(labels, i, j + shift)
    every = a if b is None else np.concatenate([a, b])
    joined = np.nonzero(labels != np.arange(len(labels)))[0]
    return every[joined], every[labels[joined]]


def near_links(fps: DataFrame, radius: int) -> DataFrame:
    """``(a, b)`` over distinct fingerprints ``fp``, with the components of all links.

    A tile is one combination of the population counts of a fingerprint's four
    16-bit parts. Two fingerprints whose counts differ by more than ``radius``
    in all differ in more than ``radius`` bits, so only neighbouring tiles
    meet; there, every pair is compared with exclusive-or and a bit count. A
    full tile is dealt into chunks of about ``CHUNK``, so no task holds more
    than two chunks and a common tile spreads over many tasks.
    """
    part = 64 // PARTS
    count = lambda i: F.bit_count(
        F.shiftrightunsigned("fp", part * i).bitwiseAND(F.lit((1 << part) - 1))
    ).cast("long")
    tile = sum((F.shiftleft(count(i), 8 * i) for i in range(1, PARTS)), count(0))
    tiled = fps.select("fp", tile.alias("tile"))
    # At most 17^4 = 83,521 tiles, however many fingerprints there are: safe to broadcast.
    sizes = keep(
        tiled.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks")),
        "tile-sizes",
    )
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    packs = keep(
        tiled.join(F.broadcast(sizes), "tile")
        .groupBy("tile", chunk.alias("chunk"))
        .agg(F.collect_list("fp").alias("fps")),
        "tiles",
    )
    steps = F.explode(F.array([F.lit(s).cast("long") for s in _steps(radius)]))
    left = (
        packs.withColumn("step", steps)
        .select(
            F.col("tile").alias("tile_a"), F.col("chunk").alias("chunk_a"),
            F.col("fps").alias("fps_a"), (F.col("tile") + F.col("step")).alias("tile"),
        )
        .join(F.broadcast(sizes), "tile")
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .filter((F.col("tile") != F.col("tile_a")) | (F.col("chunk") <= F.col("chunk_a")))
    )
    pairs = left.join(packs, ["tile", "chunk"]).select(
        "fps_a",
        F.when(
            (F.col("tile") != F.col("tile_a")) | (F.col("chunk") != F.col("chunk_a")), F.col("fps")
        ).alias("fps_b"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = [], []
            for a, b in zip(batch.column(0), batch.column(1)):
                x, y = tile_links(
                    a.values.to_numpy().view(np.uint64),
                    b.values.to_numpy().view(np.uint64) if b.is_valid else None,
                    radius,
                )
                one.append(x)
                two.append(y)
            if one:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (one, two)], ["a", "b"]
                )

    return pairs.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row: documents joined by close fingerprints.

    Documents whose fingerprints differ in ``radius`` bits or fewer are linked;
    ``component_id`` is the least id reachable. Equal fingerprints meet once,
    as one class, so copies cost nothing beyond their own row.

    NULL, empty and blank texts have fingerprint zero and are linked like any
    other. Repeated rows each get a row. A NULL id is carried along but never
    becomes a component's id; a component without any id gets NULL. An empty
    table gives an empty result. Other columns are not read.
    """
    marked = keep(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = keep(
        marked.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")),
        "classes",
    )
    linked = components(near_links(classes, radius)).select(F.col("node").alias("fp"), "root")
    rooted = classes.join(linked, "fp", "left").select(
        "fp", "first", "n", F.coalesce("root", "fp").alias("root"), F.col("root").isNotNull().alias("linked")
    )
    least = rooted.filter("linked").groupBy("root").agg(F.min("first").alias("component_id"))
    # Only classes with copies or links are looked up; the others are their own component.
    named = keep(
        rooted.filter("linked OR n > 1")
        .join(least, "root", "left")
        .select("fp", F.coalesce("component_id", "first").alias("component_id"), F.lit(True).alias("grouped")),
        "components",
    )
    return marked.join(named, "fp", "left").select(
        "doc_id",
        "fp",
        F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def fingerprint_text(fp: str = "fp"):
    """The fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")

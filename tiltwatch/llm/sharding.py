"""Shards of bounded bytes by extendible hashing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiltwatch.llm.common import keep

#: Bits of the hash: the first 15 hex digits of an MD5.
BITS = 60
#: A pass over the keys looks this many bits past the expected depth.
AHEAD = 2


def key_hash(*columns: Column) -> Column:
    """60 hash bits of the key columns; NULL counts as empty text."""
    key = F.concat_ws("\u001f", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def _prefix(hash_col: str, depth) -> Column:
    return F.expr(f"shiftright({hash_col}, {BITS} - {depth})")


def directory(rows: DataFrame, max_bytes: int, hash_col: str = "h", bytes_col: str = "bytes") -> DataFrame:
    """``(bits, prefix, shard_depth, shard_bytes, shard_rows)``: the directory of the shards.

    Rows whose first ``bits`` hash bits are ``prefix`` belong to the bucket
    named by the first ``shard_depth`` of them. A bucket is the shallowest
    prefix whose rows fit ``max_bytes`` or that has one row; only buckets above
    that are split on another bit. The rows are read once, to a row per hash with its bytes and
    rows; all else goes on from those. Bytes are counted per prefix, a few
    bits past the depth an even split would need; where that does not do, only
    the hashes still in oversized prefixes are counted again, deeper. A hash alone in its prefix
    goes to all its bits at once, as deep as it goes, and may be oversized.
    """
    keys = keep(
        rows.groupBy(F.col(hash_col).alias("h")).agg(
            F.sum(bytes_col).cast("long").alias("bytes"), F.count(F.lit(1)).alias("n")
        ),
        "hashes",
    )
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    low, bits = 0, min(BITS, max(1, (total // max_bytes).bit_length()) + AHEAD)
    done = None
    while True:
        cells = keep(
            keys.groupBy(_prefix("h", bits).alias("prefix")).agg(
                F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.min("h").alias("one"), F.max("h").alias("other")
            ),
            "cells",
        )
        # What each cell's bucket holds at every depth of this pass.
        depths = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(bits))))
        depths = depths.withColumn("bucket", F.expr(f"shiftright(prefix, {bits} - depth)"))
        held = depths.groupBy("depth", "bucket").agg(F.sum("bytes").alias("held"), F.sum("n").alias("n"))
        fits = held.filter((F.col("held") <= max_bytes) | (F.col("n") == 1) | (F.col("depth") == BITS))
        found = (
            depths.select("prefix", "depth", "bucket").join(fits, ["depth", "bucket"])
            .groupBy("prefix")
            .agg(F.min(F.struct("depth", "held", "n")).alias("s"))
            .select(
                F.lit(bits).alias("bits"), "prefix", F.col("s.depth").alias("shard_depth"),
                F.col("s.held").alias("shard_bytes"), F.col("s.n").alias("shard_rows"),
            )
        )
        found = keep(found, "directory")
        open_cells = keep(cells.join(found, "prefix", "left_anti"), "oversized")
        alone = open_cells.filter("one = other").select(
            F.lit(BITS).alias("bits"), F.col("one").alias("prefix"), F.lit(BITS).alias("shard_depth"),
            F.col("bytes").alias("shard_bytes"), F.col("n").alias("shard_rows"),
        )
        found = found.unionAll(alone)
        done = found if done is None else done.unionAll(found)
        still = open_cells.filter("one != other").select("prefix")
        if bits == BITS or still.isEmpty():
            return done
        keys = keep(keys.join(still, _prefix("h", bits) == still["prefix"], "left_semi"), "hashes")
        low, bits = bits + 1, min(BITS, bits + 8)


def shard(
    docs: DataFrame, max_bytes: int, keys: tuple[str, ...] = ("doc_id",), text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``_shard``, ``_shard_bytes`` and ``_bytes``.

    ``_shard`` names a bucket by its hash bits (``root`` before any split);
    every shard holds at most ``max_bytes`` bytes of UTF-8 text, but for a
    single row that is larger. Columns of these names are replaced.

    Rows that agree in all ``keys``, NULL included, cannot be parted by their
    hash. Where such rows alone exceed the limit they are written once with a
    row number and split on the hash of that, and the shard's name gets the
    further bits after a dash. NULL and empty texts have no bytes. An empty
    table gives an empty result.
    """
    inner = ["__shard_h", "__shard_bytes", "__shard_name", "__shard_held", "__shard_over"]
    data = docs.drop("_shard", "_shard_bytes", "_bytes", *inner)
    rows = data.withColumns({
        "__shard_h": key_hash(*[F.col(f"`{k}`") for k in keys]),
        "__shard_bytes": F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)).cast("long"),
    })
    slim = rows.select(F.col("__shard_h").alias("h"), F.col("__shard_bytes").alias("bytes"))
    listed = keep(directory(slim, max_bytes), "directory")
    name = F.when(F.col("shard_depth") == 0, F.lit("root")).otherwise(
        F.expr("lpad(bin(shiftright(prefix, bits - shard_depth)), shard_depth, '0')")
    )
    coarse = listed.agg(F.min("bits")).first()[0] or 0
    entry = F.struct(
        "bits", "prefix", name.alias("name"), F.col("shard_bytes").alias("held"),
        ((F.col("shard_rows") > 1) & (F.col("shard_bytes") > max_bytes)).alias("over"),
    )
    # One row per prefix of the least depth, with the few entries below it, so that every row finds its own by one join.
    named = keep(
        listed.groupBy(F.expr(f"shiftright(prefix, bits - {coarse})").alias("__shard_prefix"))
        .agg(F.collect_list(entry).alias("__shard_entries")),
        "entries",
    )
    here = F.filter("__shard_entries", lambda e: F.call_function(
        "shiftright", F.col("__shard_h"), F.lit(BITS) - e["bits"]) == e["prefix"])
    placed = (
        rows.join(named, _prefix("__shard_h", coarse) == named["__shard_prefix"])
        .withColumn("__shard_entry", here[0])
        .withColumns({f"__shard_{c}": F.col(f"__shard_entry.{c}") for c in ("name", "held", "over")})
        .drop("__shard_prefix", "__shard_entries", "__shard_entry")
    )
    if not listed.filter((F.col("shard_rows") > 1) & (F.col("shard_bytes") > max_bytes)).isEmpty():
        placed = placed.filter("NOT __shard_over").unionByName(
            _split_alike(placed.filter("__shard_over"), max_bytes)
        )
    return placed.withColumns({
        "_shard": F.col("__shard_name"), "_shard_bytes": F.col("__shard_held"), "_bytes": F.col("__shard_bytes")
    }).drop(*inner)


def _split_alike(placed: DataFrame, max_bytes: int) -> DataFrame:
    """Rows with one key above the limit, split further on the bits of their row number's hash."""
    alike = keep(placed.withColumn("__shard_n", F.monotonically_increasing_id()), "alike")
    # Even hashes leave a cell of so many bits half full; one that is not is split below.
    depth = F.least(F.lit(BITS), F.greatest(F.lit(1), F.ceil(F.log2(F.col("__shard_held") / max_bytes)) + 1))
    rows = alike.withColumns({"__shard_g": key_hash(F.col("__shard_n")), "__shard_depth": depth.cast("int")})
    cell = F.expr(f"shiftright(__shard_g, {BITS} - __shard_depth)")
    key = ["__shard_h", "__shard_depth", "__shard_cell"]
    while True:
        cut = rows.withColumn("__shard_cell", cell)
        cells = keep(
            cut.groupBy(*key).agg(
                F.sum("__shard_bytes").alias("__shard_sum"), F.count(F.lit(1)).alias("n_rows")
            ),
            "alike-cells",
        )
        bad = cells.filter(
            (F.col("__shard_sum") > max_bytes) & (F.col("n_rows") > 1) & (F.col("__shard_depth") < BITS)
        )
        if bad.isEmpty():
            break
        rows = (
            cut.join(bad.select(*key, F.lit(1).alias("__shard_more")), key, "left")
            .withColumn("__shard_depth", F.expr("__shard_depth + coalesce(__shard_more, 0)"))
            .drop("__shard_cell", "__shard_more")
        )
    bits = F.expr("lpad(bin(__shard_cell), __shard_depth, '0')")
    return (
        cut.join(cells.drop("n_rows"), key)
        .withColumns({
            "__shard_name": F.concat("__shard_name", F.lit("-"), bits), "__shard_held": F.col("__shard_sum")
        })
        .select(*placed.columns)
    )

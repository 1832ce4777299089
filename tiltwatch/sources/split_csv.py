"""Large quoted CSV files read in parallel, although their records may span lines."""

from __future__ import annotations

import csv
from collections.abc import Collection, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiltwatch.schemas import MULTI_LINE, TABLES, TYPES
from tiltwatch.sources.csv import OPTIONS, load_csv, typed
from tiltwatch.sources.layout import scan_session
from tiltwatch.sources.tables import save_table

SPLIT_BYTES = 128 * 1024 * 1024
#: Blocks are smaller where there would be fewer than cores, but not below this for it.
LEAST_BYTES = 4 * 1024 * 1024
#: Kinds of pieces: a whole record, the rest of one begun in an earlier block, the beginning of one.
WHOLE, REST, BEGIN = 0, 1, 2


def _odd_blocks(lines: DataFrame) -> list[int]:
    """Blocks that start within quotes: those with an odd number of quotes before them in their file.

    Quotes are summed per block, then along the blocks of each file. The
    driver gets eight bytes for each such block of ``SPLIT_BYTES``. A file that
    ends within quotes fails the job.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("path", "start", "block").agg(F.sum(quotes).alias("quotes"))
    so_far = F.sum("quotes").over(Window.partitionBy("path").orderBy("start"))
    last = F.lead("start").over(Window.partitionBy("path").orderBy("start")).isNull()
    open_end = F.raise_error(F.concat(F.lit("a quoted field is never closed in "), F.col("path")))
    odd = blocks.select(
        "block", ((so_far - F.col("quotes")) % 2 == 1).alias("odd"),
        F.when(last & (so_far % 2 == 1), open_end.cast("boolean")).otherwise(F.lit(True)).alias("closed"),
    )
    return sorted(r["block"] for r in odd.filter("closed").filter("odd").select("block").collect())


def _pieces(lines: DataFrame, odd: list[int], header: list[str], whole: bool) -> DataFrame:
    """``(record, kind, path, start)``: whole records, or the pieces of those that cross into another block.

    Reads each block's lines in order; path and start are set for pieces only. Lines that are a
    record each are told apart by the whole batch; only the others are looked at one by one.
    """
    odd_blocks = frozenset(odd)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = None  # block, path, start
        held: list[str] = []  # lines of a record that is not complete yet
        quoted = crossed = headed = fresh = False
        out: list[tuple] = []

        def ended() -> list[tuple]:
            if not held:
                return []
            if headed:
                raise ValueError(f"the header of {here[1]} does not end in its first block")
            return [("\n".join(held), REST if crossed else BEGIN, here[1], here[2])]

        def add(line: str, turns: bool) -> None:
            """The next line, which has an odd number of quotes if it ``turns``."""
            nonlocal held, quoted, crossed, headed, fresh
            held.append(line.removeprefix("﻿") if fresh else line)
            fresh = False
            quoted ^= turns
            if quoted:
                return
            record, held = "\n".join(held), []
            if crossed:
                out.append((record, REST, here[1], here[2]))
                crossed = False
                return
            if record.endswith("\r"):  # as the other reader does in such files, also within quotes
                record = record[:-1].replace("\r\n", "\n")
            if not record:
                return
            if headed:
                found = next(csv.reader(record.split("\n")))
                if found != header:
                    raise ValueError(f"the header of {here[1]} is {found}, not {header}")
                headed = False
            else:
                out.append((record, WHOLE, None, None))

        def taken() -> Iterator[pa.RecordBatch]:
            rows = [row for row in out if (row[1] == WHOLE) == whole]
            out.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

        for batch in batches:
            block, path, start, value = batch.columns
            keys = block.to_numpy()
            turns = pc.bit_wise_and(pc.count_substring(value, '"'), 1).to_numpy(zero_copy_only=False).astype(bool)
            edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else []
            for at, end in zip(edges, edges[1:]):
                if here is None or keys[at] != here[0]:
                    out += ended()
                    here, held = (int(keys[at]), path[at].as_py(), start[at].as_py()), []
                    quoted = crossed = here[0] in odd_blocks
                    headed = fresh = here[2] == 0
                while headed and at < end:
                    add(value[at].as_py(), bool(turns[at]))
                    at += 1
                after = quoted ^ (np.cumsum(turns[at:end]) % 2 == 1)
                alone = ~after & ~np.concatenate(([quoted], after[:-1]))[: end - at]
                if whole and alone.any():
                    records = pc.replace_substring_regex(value.slice(at, end - at).filter(pa.array(alone)), "\\r\\z", "")
                    records = records.filter(pc.not_equal(pc.binary_length(records), 0)).cast(pa.string())
                    zeros = pa.array(np.zeros(len(records), np.int32))
                    none = [pa.nulls(len(records), t) for t in kinds[2:]]
                    yield pa.RecordBatch.from_arrays([records, zeros, *none], names)
                for i in np.flatnonzero(~alone).tolist():
                    add(value[at + i].as_py(), bool(turns[at + i]))
            yield from taken()
        out += ended()
        yield from taken()

    names, kinds = ["record", "kind", "path", "start"], [pa.string(), pa.int32(), pa.string(), pa.int64()]
    rows = lines.select("block", "path", "start", "value")
    return rows.mapInArrow(run, "record string, kind int, path string, start long")


def load_split_csv(
    spark: SparkSession, path: str | list[str], types: StructType | None = None, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """What :func:`tiltwatch.sources.csv.load_csv` reads, with every block of a file read by a task of its own.

    Whether a line break ends a record depends on whether the quotes before it
    are balanced. One pass counts quotes per block of ``split_bytes``; sums along
    each file tell which blocks start within quotes. A second pass cuts
    each block into records; only the pieces of records that cross from block to block, two
    per block at most, are shuffled to be put together.

    Records end at a line feed, with or without a carriage return before it; in a
    record that ends with both, both together count as a line feed within quotes as well. Fields
    that hold quotes must be quoted, and quotes in them doubled, as OPTIONS
    say: a lone quote in a bare field would be taken for an opening one. Files whose
    header differs, or that end within quotes, fail the job. Empty lines are no records; a
    missing file is an error; a folder of empty files has no header and is one, too.
    """
    header = spark.read.options(**OPTIONS, multiLine="true", enforceSchema="false").csv(path).columns
    own = scan_session(spark, split_bytes)
    own.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    own.conf.set("spark.sql.files.openCostInBytes", str(LEAST_BYTES))
    at = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    lines = own.read.option("lineSep", "\n").text(path).select(
        F.xxhash64(*at).alias("block"), at[0].alias("path"), at[1].alias("start"), "value"
    )
    odd = _odd_blocks(lines)
    parts = _pieces(lines, odd, header, whole=False)
    in_order = Window.partitionBy("path").orderBy("start", "kind")
    number = F.sum((F.col("kind") == BEGIN).cast("long")).over(in_order)
    crossing = (
        parts.withColumn("number", number).groupBy("path", "number")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "record"))).alias("parts"))
        .select(F.array_join(F.transform("parts", lambda x: x["record"]), "\n").alias("record"))
        .select(
            F.when(
                F.endswith("record", F.lit("\r")),
                F.replace(F.left("record", F.length("record") - 1), F.lit("\r\n"), F.lit("\n")),
            ).otherwise(F.col("record")).alias("record")
        )
    )
    records = _pieces(lines, odd, header, whole=True).select("record").unionAll(crossing)
    ddl = ", ".join("`{}` STRING".format(name.replace("`", "``")) for name in header)
    raw = records.select(F.from_csv("record", F.lit(ddl), OPTIONS | {"multiLine": "true", "header": "false"}).alias("r"))
    return typed(raw.select("r.*"), types)


def load_all(
    spark: SparkSession,
    folder: str,
    database: str,
    files: Sequence[str] = tuple(TABLES),
    multi_line: Collection[str] = MULTI_LINE,
) -> list[str]:
    """Load each named CSV under ``folder`` into its table; returns the table names.

    Files named in ``multi_line`` may have line breaks in quoted fields; all are read in parallel.
    """
    names = []
    for file in files:
        table, path = f"{database}.{TABLES[file]}", f"{folder}/{file}.csv"
        if file in multi_line:
            save_table(load_split_csv(spark, path, TYPES[file]), table)
        else:
            save_table(load_csv(spark, path, TYPES[file], multi_line=False), table)
        names.append(table)
    return names

"""File layout of tables: few even files, optionally clustered by one column or along a curve through several."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tiltwatch.config import work_folder

FILE_BYTES = 128 * 1024 * 1024
#: Row groups of compacted files: scans cut a file at them, so one task need not take a whole file.
ROW_GROUP_BYTES = 16 * 1024 * 1024
#: Stored bytes that one task sorts at most, and so writes as a file; sorted rows in memory take many times that.
SORT_BYTES = 32 * 1024 * 1024
#: A task that packs files takes about so many pieces, so that uneven files still make even tasks.
PIECES = 4
#: Small files that a task opens one after the other without much delay.
MANY = 32
#: Bits of a column's rank on the curve; the bounds between ranks are 2^BITS - 1 sampled quantiles.
BITS = 8


def own_session(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` to set otherwise. The catalog is shared; the settings of ``spark`` stay as they are."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    return own


def scan_session(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session like ``spark`` whose file scans have splits of ``split_bytes``, whatever the cluster's size.

    Small files are packed into a split up to that size, large ones are cut.
    """
    own = own_session(spark)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    return own


def fold_session(spark: SparkSession, stored_bytes: int) -> SparkSession:
    """A session like ``spark`` for joins and folds by keys that nearly every row has for itself.

    A task holds the keys of what it reads in memory, many times their stored size. So
    splits and shuffle partitions end at ``SORT_BYTES`` and half of that, unless they are set lower, and the number
    of shuffle partitions goes with ``stored_bytes``, the size of the rows.
    """
    own = own_session(spark)
    for key, most in (("files.maxPartitionBytes", SORT_BYTES), ("adaptive.advisoryPartitionSizeInBytes", SORT_BYTES // 2)):
        given = spark._jsparkSession.sessionState().conf().getConfString(f"spark.sql.{key}")
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(given) > most:
            own.conf.set(f"spark.sql.{key}", str(most))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * stored_bytes // SORT_BYTES)
    own.conf.set("spark.sql.shuffle.partitions", str(tasks))
    return own


def _ordinal(df: DataFrame, column: str) -> Column:
    """A number in the column's order; texts by their first seven bytes, so equal beginnings tie."""
    kind = df.schema[column].dataType.typeName()
    value = F.col(f"`{column}`")
    if kind in ("string", "binary"):
        start = F.substring(value.cast("binary"), 1, 7)
        return F.conv(F.rpad(F.hex(start), 14, "0"), 16, 10).cast("double")
    if kind == "date":
        return F.unix_date(value).cast("double")
    if kind == "timestamp":
        return F.unix_micros(value).cast("double")
    return value.cast("int").cast("double") if kind == "boolean" else value.cast("double")


def _step_up_to(value: Column, bounds: Column):
    return lambda rank, step: F.when(F.element_at(bounds, rank + step) <= value, rank + step).otherwise(rank)


def curve(df: DataFrame, columns: Sequence[str], sample_rows: int = 1_000_000) -> Column:
    """Place of a row on a space-filling curve (Z-order) through ``columns``, as one expression.

    Each column is cut at its quantiles into 2^``BITS`` ranks, so a skewed
    column fills its ranks evenly; the ranks' bits are interleaved. Quantiles
    come from a sample of about ``sample_rows`` rows: they decide where files
    are cut, never what is in them. NULL and NaN rank first and last. At most seven columns.
    """
    if not 0 < len(columns) <= 63 // BITS:
        raise ValueError(f"one to {63 // BITS} columns, not {len(columns)}")
    named = {f"c{i}": _ordinal(df, c) for i, c in enumerate(columns)}
    total = df.count()
    sampled = df.select(*(v.alias(k) for k, v in named.items()))
    if total > sample_rows:
        sampled = sampled.sample(sample_rows / total, seed=7)
    shares = [i / 2**BITS for i in range(1, 2**BITS)]
    # Numbers on the driver: columns times 2^BITS.
    found = sampled.select(*(F.percentile_approx(c, shares, 10_000).alias(c) for c in named)).first()
    steps = F.array(*(F.lit(2**k) for k in reversed(range(BITS))))
    place = F.lit(0).cast("long")
    for i, (name, value) in enumerate(named.items()):
        if found[name] is None:
            continue
        bounds = F.array(*map(F.lit, found[name]))
        # Binary search for the number of bounds that do not exceed the value.
        rank = F.aggregate(steps, F.lit(0), _step_up_to(value, bounds))
        for k in range(BITS):
            bit = F.shiftright(rank, k).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(bit, k * len(columns) + i))
    return place


def clustered(df: DataFrame, columns: Sequence[str], partitions: int, by_curve: bool = False) -> DataFrame:
    """Rows in even parts, range-partitioned and sorted by ``columns``, so scans can skip row groups.

    One column after the other, so that a filter on the first one skips most;
    ``by_curve`` orders them along :func:`curve` instead, so that a filter on
    any of them skips.

    ``df`` must be a plain file scan. The file position closes the sort key: it
    lets range bounds fall inside one hot value, so its rows spread over several
    partitions, and it never changes when a task is retried.
    """
    positioned = df.withColumns(
        {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    )
    keys = list(columns)
    if by_curve:
        positioned, keys = positioned.withColumn("_place", curve(df, columns)), ["_place"]
    spread = positioned.repartitionByRange(partitions, *keys, "_row", "_file")
    return spread.sortWithinPartitions(*keys).drop("_row", "_file", "_place")


def table_folder(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return rows.select("data_type").first()[0]


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def folder_bytes(spark: SparkSession, folder: str) -> int:
    """Size of all files under ``folder``, from file-system metadata."""
    fs, path = _file_system(spark, folder)
    return fs.getContentSummary(path).getLength()


def file_count(spark: SparkSession, folder: str) -> int:
    """Number of files under ``folder``, one at least."""
    fs, path = _file_system(spark, folder)
    return max(1, fs.getContentSummary(path).getFileCount())


def has_stream_log(spark: SparkSession, folder: str) -> bool:
    fs, path = _file_system(spark, folder)
    return fs.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_spark_metadata"))


def _packed(
    spark: SparkSession, read: Callable[[SparkSession], DataFrame], folders: Sequence[str], files: int
) -> DataFrame:
    """The rows that ``read`` finds in ``folders`` in ``files`` partitions, each of some whole pieces of the old files."""
    size = sum(folder_bytes(spark, f) for f in folders)
    # Files of usual size stay whole: a file has often a single row group, and a cut would leave one half without rows.
    usual = -(-size * 6 // (5 * sum(file_count(spark, f) for f in folders)))
    piece = min(-(-size // files), max(-(-size // (files * PIECES)), usual))
    return read(scan_session(spark, max(1, piece))).coalesce(files)


def _write_packed(
    spark: SparkSession,
    read: Callable[[SparkSession], DataFrame],
    folders: Sequence[str],
    file_bytes: int,
    write: Callable[[DataFrame], None],
) -> None:
    """``write`` the rows in few files, without a shuffle.

    Opening files is what takes time when they are tiny. Where one task would have to open very many while
    others have none, all tasks first pack them into a few larger ones.
    """
    files = max(1, -(-sum(folder_bytes(spark, f) for f in folders) // file_bytes))
    count = sum(file_count(spark, f) for f in folders)
    tasks = min(spark.sparkContext.defaultParallelism, count // MANY)
    if tasks < 2 * files:
        write(_packed(spark, read, folders, files))
        return
    step = work_folder(spark, "packed")
    _grouped(_packed(spark, read, folders, tasks)).parquet(step)
    _write_packed(spark, lambda own: own.read.parquet(step), [step], file_bytes, write)
    fs, path = _file_system(spark, step)
    fs.delete(path, True)


def _clustered(
    spark: SparkSession, rows: DataFrame, folder: str, columns: Sequence[str], file_bytes: int, by_curve: bool
) -> DataFrame:
    """Rows clustered in files of ``file_bytes``, or ``SORT_BYTES`` if that is less: one task sorts a file."""
    return clustered(rows, columns, max(1, -(-folder_bytes(spark, folder) // min(file_bytes, SORT_BYTES))), by_curve)


def _grouped(rows: DataFrame) -> DataFrameWriter:
    return rows.write.option("parquet.block.size", ROW_GROUP_BYTES)


def compact_parts(spark: SparkSession, folders: Sequence[str], target: str, file_bytes: int = FILE_BYTES) -> None:
    """Write the Parquet rows of several folders into few files under ``target``, in place of what is there.

    Nothing is shuffled. Columns that only some folders have are NULL in the rows of the others.
    """
    _write_packed(
        spark, lambda own: own.read.option("mergeSchema", "true").parquet(*folders), folders, file_bytes,
        lambda rows: _grouped(rows).mode("overwrite").parquet(target),
    )


def compact_files(
    spark: SparkSession,
    folder: str,
    target: str,
    cluster_by: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
    by_curve: bool = False,
) -> None:
    """Write the Parquet rows of ``folder`` into few files under the new ``target``."""

    def write(rows: DataFrame) -> None:
        _grouped(rows).mode("errorifexists").parquet(target)

    if cluster_by:
        write(_clustered(spark, spark.read.parquet(folder), folder, cluster_by, file_bytes, by_curve))
    else:
        _write_packed(spark, lambda own: own.read.parquet(folder), [folder], file_bytes, write)


def compact_table(
    spark: SparkSession,
    table: str,
    cluster_by: Sequence[str] = (),
    file_bytes: int = FILE_BYTES,
    by_curve: bool = False,
) -> str:
    """Rewrite ``table`` into few files; returns the name the old copy now has.

    The new copy is complete before the names are swapped, so a lost executor or
    a failed run leaves the table as it was; a driver lost between the two renames
    is made good by :func:`recover_table`. The old copy stays until
    :func:`drop_previous`. A table fed by a file stream is
    refused, since its stream log lists the old files; a stream into
    :class:`tiltwatch.streaming.batches.BatchTarget` can be compacted while it runs.
    """
    folder = table_folder(spark, table)
    if has_stream_log(spark, folder):
        raise ValueError(f"{table} is the target of a stream and cannot be compacted")
    mark = uuid.uuid4().hex[:8]
    fresh, previous = f"{table}_new_{mark}", f"{table}_old_{mark}"

    def write(rows: DataFrame) -> None:
        _grouped(rows).format("parquet").mode("errorifexists").saveAsTable(fresh)

    if cluster_by:
        write(_clustered(spark, spark.table(table), folder, cluster_by, file_bytes, by_curve))
    else:
        _write_packed(spark, lambda own: own.table(table), [folder], file_bytes, write)
    spark.sql(f"ALTER TABLE {table} RENAME TO {previous}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except Exception:
        spark.sql(f"ALTER TABLE {previous} RENAME TO {table}")
        raise
    return previous


def recover_table(spark: SparkSession, table: str) -> bool:
    """Put the new copy in place where a driver was lost between the two renames.

    Returns whether anything had to be done: ``table`` is missing and exactly
    one compaction left both its copies.
    """
    if spark.catalog.tableExists(table):
        return False
    database, _, name = table.rpartition(".")
    names = {t.name for t in spark.catalog.listTables(database or None)}
    marks = [n.removeprefix(f"{name}_old_") for n in names if n.startswith(f"{name}_old_")]
    marks = [m for m in marks if f"{name}_new_{m}" in names]
    if len(marks) != 1:
        return False
    spark.sql(f"ALTER TABLE {table}_new_{marks[0]} RENAME TO {table}")
    return True


def drop_previous(spark: SparkSession, previous: str) -> None:
    """Drop the old copy that :func:`compact_table` named."""
    if "_old_" not in previous:
        raise ValueError(f"{previous} is no old copy")
    spark.sql(f"DROP TABLE IF EXISTS {previous}")

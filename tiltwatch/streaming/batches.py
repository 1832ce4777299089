"""A stream target of Parquet parts per batch, which replays replace and compaction may merge at any time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tiltwatch.sources.layout import FILE_BYTES, compact_parts, folder_bytes
from tiltwatch.sources.parts import Part, PartFolder, tail
from tiltwatch.streaming.scoring import score


@dataclass(frozen=True)
class BatchTarget(PartFolder):
    """A folder of parts, and the checkpoint of the stream that fills it.

    Each batch is written to a part named by its number, so a batch that is
    run again after a failure replaces what it had written.
    """

    checkpoint: str

    def write_batch(self, rows: DataFrame, batch: int) -> None:
        self.write(rows, Part(batch, batch))

    def committed(self, spark: SparkSession) -> int:
        """Number of the last batch that will not be run again; -1 before the first."""
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.checkpoint}/commits")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return -1
        names = [status.getPath().getName() for status in fs.listStatus(path)]
        return max((int(name) for name in names if name.isdigit()), default=-1)

    def settled(self, spark: SparkSession) -> list[Part]:
        """The live parts of committed batches."""
        last = self.committed(spark)
        return [p for p in self.live(spark) if p.last <= last]

    def compact(self, spark: SparkSession, file_bytes: int = FILE_BYTES, whole: bool = False) -> Part | None:
        """Merge the newest committed parts into one, without a shuffle; None where there is nothing to merge.

        See :func:`tiltwatch.sources.parts.tail` for which. May run beside the
        stream and beside readers: a batch not committed yet may still be replayed and is left
        alone, and covered parts stay until :meth:`clean`.
        """
        settled = self.settled(spark)
        parts = tail(settled, [folder_bytes(spark, self.place(p)) for p in settled], whole)
        if not parts:
            return None
        merged = Part(parts[0].first, parts[-1].last)
        compact_parts(spark, [self.place(p) for p in parts], self.place(merged), file_bytes)
        return merged


def score_into_batches(
    spark: SparkSession,
    source: str | DataFrame,
    target: BatchTarget,
    model: Transformer,
    partitions: int | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Score what is new in ``source`` into ``target`` and stop when caught up.

    Like :func:`tiltwatch.streaming.scoring.score_stream`, but the target can be
    compacted while the stream runs.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.table(source) if isinstance(source, str) else source
    scored = score(stream, model, partitions)
    return (
        scored.writeStream.foreachBatch(target.write_batch)
        .trigger(availableNow=True)
        .option("checkpointLocation", target.checkpoint)
        .start()
    )

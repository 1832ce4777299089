"""Scoring chat with one function for batch tables and streams."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tiltwatch.sources.layout import has_stream_log, table_folder
from tiltwatch.sources.tables import add_missing_columns, save_table

# Columns of the model that scored chat does not keep.
_HELPER_COLUMNS = ("document", "token", "universal_embeddings", "class")


def score(chat: DataFrame, model: Transformer, partitions: int | None = None) -> DataFrame:
    """Chat with its predicted label set, from a batch or a stream.

    The text is in ``comment_text`` or, before scoring, in ``key``. Scoring is
    row by row, so no shuffle is needed; ``partitions`` adds one to spread a
    badly split input over more tasks.
    """
    named = chat.withColumnRenamed("key", "comment_text")
    if partitions:
        named = named.repartition(partitions)
    labelled = model.transform(named).withColumn("predicted", F.col("class.result"))
    return labelled.drop(*_HELPER_COLUMNS)


def score_table(
    spark: SparkSession, source: str, target: str, model: Transformer, partitions: int | None = None
) -> None:
    """Score a whole table into ``target``, replacing it."""
    save_table(score(spark.table(source), model, partitions), target)


@dataclass(frozen=True)
class StreamTarget:
    """A table and the checkpoint that says which input it already holds."""

    table: str
    checkpoint: str

    def fresh(self) -> "StreamTarget":
        """A new pair to start over with.

        A new checkpoint alone would append all rows a second time, so both
        change together; the old pair is left as it is.
        """
        mark = uuid.uuid4().hex[:8]
        return StreamTarget(f"{self.table}_{mark}", f"{self.checkpoint.rstrip('/')}_{mark}")


def score_stream(
    spark: SparkSession,
    source: str | DataFrame,
    target: StreamTarget,
    model: Transformer,
    partitions: int | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Score what is new in ``source`` into ``target`` and stop when caught up.

    A large backlog can be cut into batches of ``files_per_batch`` files; a
    failure then repeats one batch only.

    Offsets live in the checkpoint and the file sink commits whole batches, so a
    restarted run neither loses nor repeats rows. Columns that an existing target
    lacks are added to it first. A target with rows that no stream wrote is
    refused, since the sink's log would hide them from readers.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.table(source) if isinstance(source, str) else source
    scored = score(stream, model, partitions)
    if spark.catalog.tableExists(target.table):
        streamed = has_stream_log(spark, table_folder(spark, target.table))
        if not streamed and not spark.table(target.table).isEmpty():
            raise ValueError(f"{target.table} holds rows that no stream wrote")
        add_missing_columns(spark, target.table, scored)
    return (
        scored.writeStream.format("parquet")
        .outputMode("append")
        .trigger(availableNow=True)
        .option("checkpointLocation", target.checkpoint)
        .toTable(target.table)
    )


def wait(query: StreamingQuery, seconds: int | None = None) -> bool:
    """Block until the stream has caught up, or ``seconds`` passed; re-raises its failure."""
    if seconds is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(seconds))

"""Chat, player, match and region tables read from an order star schema.

Each order stands for a match, each line for a chat message, each
``(order, line number)`` for a seat in the match.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiltwatch.functions.labels import label_set

# Schemas already seen, by session and state of the file or folder; reading one again costs a job.
_SCHEMAS: dict[tuple, StructType] = {}


def state(spark: SparkSession, folder: str, name: str) -> tuple:
    """The session, path, size and time of change of a table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
    return spark.sparkContext.applicationId, str(path), status.getLen(), status.getModificationTime()


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    path = f"{folder}/{name}.parquet"
    key = state(spark, folder, name)
    if key not in _SCHEMAS:
        _SCHEMAS[key] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[key]).parquet(path)


def _line_flags() -> dict[str, Column]:
    returned = F.col("l_returnflag") == "R"
    return {
        "toxic": returned,
        "severe_toxic": returned & (F.col("l_discount") >= 0.09),
        "obscene": returned & (F.col("l_tax") >= 0.06),
        "threat": returned & (F.col("l_quantity") >= 48),
        "insult": (F.col("l_linestatus") == "F") & (F.col("l_quantity") >= 40),
        "identity_hate": returned & (F.col("l_quantity") <= 2),
    }


def _message_columns() -> list[Column]:
    time = (F.col("l_orderkey") * 7 + F.col("l_partkey") * 13 + F.col("l_linenumber")) % 3000 - 300
    no_text = F.col("l_quantity") == 7
    text = F.when(no_text, None).otherwise(F.concat(F.lit("msg "), F.col("l_partkey")))
    return [
        F.col("l_orderkey").alias("match_id"),
        F.col("l_linenumber").alias("slot"),
        time.alias("time"),
        text.alias("comment_text"),
        F.concat(F.lit("u"), F.col("l_suppkey")).alias("unit"),
    ]


def chat(spark: SparkSession, folder: str) -> DataFrame:
    """Unscored chat: ``match_id, slot, time, key, unit``."""
    lines = read(spark, folder, "lineitem").select(*_message_columns())
    return lines.withColumnRenamed("comment_text", "key")


def chat_pred(spark: SparkSession, folder: str) -> DataFrame:
    """Scored chat: as ``chat`` with ``comment_text`` and ``predicted``."""
    lines = read(spark, folder, "lineitem")
    return lines.select(*_message_columns(), label_set(_line_flags()).alias("predicted"))


def training(spark: SparkSession, folder: str) -> DataFrame:
    """Comments with six multi-hot text flags, as a CSV load would give them."""
    lines = read(spark, folder, "lineitem")
    flags = [
        F.when(cond, F.lit("1")).otherwise(F.lit("0")).alias(label)
        for label, cond in _line_flags().items()
    ]
    return lines.select(*_message_columns()[:4], *flags)


def players(spark: SparkSession, folder: str) -> DataFrame:
    """One account per match and seat."""
    lines = read(spark, folder, "lineitem")
    return lines.groupBy(
        F.col("l_orderkey").alias("match_id"), F.col("l_linenumber").alias("player_slot")
    ).agg(F.min("l_suppkey").alias("account_id"))


def matches(spark: SparkSession, folder: str) -> DataFrame:
    orders = read(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("match_id"), (F.col("o_custkey") % 25).alias("cluster")
    )


def cluster_regions(spark: SparkSession, folder: str) -> DataFrame:
    nation = read(spark, folder, "nation")
    region = read(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("cluster"), F.col("r_name").alias("region")
    )


def flags(spark: SparkSession, folder: str) -> DataFrame:
    """The flags ``toxic`` and ``low_quality`` of the labelled documents."""
    labels = read(spark, folder, "labels")
    return labels.select("doc_id", "toxic", (1 - F.col("quality")).alias("low_quality"))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "documents").select("doc_id", F.col("text").alias("comment_text"))


def comments(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents: their text and flags."""
    return texts(spark, folder).join(flags(spark, folder), "doc_id")


class GameTables:
    """The four tables that the reports read, each set up when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self._source = (spark, folder)

    @cached_property
    def chat(self) -> DataFrame:
        return chat_pred(*self._source)

    @cached_property
    def players(self) -> DataFrame:
        return players(*self._source)

    @cached_property
    def matches(self) -> DataFrame:
        return matches(*self._source)

    @cached_property
    def cluster_regions(self) -> DataFrame:
        return cluster_regions(*self._source)

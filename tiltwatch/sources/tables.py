"""Databases and Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """Create the database if missing and make it current. Never drops anything."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    spark.sql(f"USE `{name}`")
    return name


def drop_database(spark: SparkSession, name: str) -> None:
    """Drop the database with all its tables."""
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def save_table(df: DataFrame, table: str) -> None:
    """Replace ``table`` with ``df``. ``df`` must not read ``table`` itself."""
    df.write.format("parquet").mode("overwrite").saveAsTable(table)


def save_gold(report: DataFrame, table: str) -> None:
    """Save a report in its order, in the partitions it ends in.

    Adaptive execution merges small ones, so a report of few rows is one file;
    a large one is written by many tasks.
    """
    save_table(report, table)


def add_missing_columns(spark: SparkSession, table: str, df: DataFrame) -> list[str]:
    """Add to ``table`` the columns that only ``df`` has; old rows read NULL there."""
    present = {c.lower() for c in spark.table(table).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in present]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def append_evolving(spark: SparkSession, df: DataFrame, table: str) -> None:
    """Append by name, widening the table where ``df`` has new columns."""
    if not spark.catalog.tableExists(table):
        df.write.format("parquet").saveAsTable(table)
        return
    add_missing_columns(spark, table, df)
    given = {c.lower() for c in df.columns}
    aligned = df.select(
        *[
            F.col(f.name) if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spark.table(table).schema.fields
        ]
    )
    aligned.write.insertInto(table)

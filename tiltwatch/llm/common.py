"""What several operators share: words, table reads, written intermediates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiltwatch.config import work_folder

# A word is a run of characters outside these six.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keep(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared work folder and read back.

    Cuts the lineage in a way that outlives any executor, keeps rows that a
    rerun might order otherwise, and gives the planner the true size.
    """
    spark = df.sparkSession
    folder = work_folder(spark, f"llm-{purpose}")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def drop_kept(df: DataFrame) -> None:
    """Delete what :func:`keep` wrote for ``df``, once nothing reads it any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if "/llm-" in folder.toString():
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def word_count(text: Column) -> Column:
    """Number of words as a long, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD_CLASS}+")), F.lit(0)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Rows kept from learning: crc32 of the id as text leaves 2 when divided by 4.

    An id of NULL is not held out; callers do not learn from it either.
    """
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def drawn(purpose: str, key: Column, share: float) -> Column:
    """Whether a hash of ``key`` falls into the lowest ``share`` of all 2^64; any share is told apart from none."""
    if share >= 1:
        return F.lit(True)
    return F.xxhash64(F.lit(purpose), key) < F.lit(int(share * 2.0**64) - (1 << 63))


def learnable(doc_id: Column) -> Column:
    return doc_id.isNotNull() & ~held_out(doc_id)

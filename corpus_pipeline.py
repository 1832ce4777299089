"""From raw documents to shards: each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiltwatch.llm import decontamination, langid, mixing, sharding, simhash
from tiltwatch.llm.common import keep, read
from tiltwatch.llm.queries import SHARD_BYTES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Languages to keep; None keeps every one that the labels name.
WANTED: tuple[str, ...] | None = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a wanted language, with the language they are in.

    Text that is NULL or has no letter is in none and goes. Where the
    prediction is clear it replaces a label that is missing or says otherwise.
    Where the second-best language comes close, the label stands if there is
    one; without a label nothing tells the language, and the document goes.
    Repeated rows and ids are judged row by row, an id may be NULL; other columns than
    those of ``documents`` are not returned; an empty table gives an empty one.
    """
    found = langid.identify(docs, langid.fit(docs))
    told = F.when(F.col("_ambiguous"), F.col("lang")).otherwise(F.col("_lang"))
    found = found.filter(F.col("_lang") != langid.UNKNOWN).withColumn("lang", told).filter("lang IS NOT NULL")
    if WANTED is not None:
        found = found.filter(F.col("lang").isin(*WANTED))
    return found.select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the least id.

    Rows that share an id share its fate; a group without ids stays whole.
    Texts that are NULL or empty share the fingerprint zero and are a group
    like any other. An empty table gives an empty one.
    """
    found = simhash.near_duplicates(docs, shingle=3, radius=2)
    gone = keep(
        found.filter("component_id != doc_id OR (doc_id IS NULL AND component_id IS NOT NULL)")
        .select(F.col("doc_id").alias("__gone")).distinct(),
        "gone",
    )
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["__gone"]), "left_anti").select(*COLUMNS)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    NULL and empty texts hold none and stay, as do all documents if there are
    no items. Each row of a repeated id is judged by its own text.
    """
    return decontamination.decontaminate(docs, read(spark, sf_dir, "benchmark")).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; one cut by the mix has its first words.

    NULL is a source like any other, NULL and blank texts have no words and
    are never taken. ``n_chars`` is counted anew; an empty table gives an empty one.
    """
    taken = mixing.take(mixing.mix(docs))
    return taken.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the shard each belongs to.

    Every row has one, also with NULL ids or texts (no bytes); rows that share
    an id are parted only where one shard cannot hold them. An empty table gives an empty one.
    """
    placed = sharding.shard(docs, SHARD_BYTES)
    return placed.select(
        *COLUMNS, F.col("_shard").alias("shard"), F.col("_bytes").alias("bytes"),
        F.col("_shard_bytes").alias("shard_bytes"),
    )


STAGES = [
    ("language_id", language),
    ("simhash_dedup", near_duplicates),
    ("decontamination", clean_of_benchmark),
    ("mixing", mixed),
    ("sharding", shards),
]

#: XXH64 fingerprints and trained classifiers have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table, each written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

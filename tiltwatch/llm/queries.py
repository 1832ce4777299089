"""The operators applied to whole tables with production parameters, as ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiltwatch.llm import (
    centroids,
    decontamination,
    langid,
    mixing,
    passages,
    pii,
    repetition,
    sharding,
    simhash,
    spelling,
    templates,
    toxicity,
    urls,
)
from tiltwatch.llm.common import held_out, read

Query = Callable[[SparkSession, str], DataFrame]

#: Bytes of text that a shard may hold.
SHARD_BYTES = 1 << 20
#: The contract's rules: host, path, verdict.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
TOXIC_FROM = 0.3


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    placed = sharding.shard(docs, SHARD_BYTES)
    return placed.select(
        "doc_id", F.col("_shard").alias("shard"), F.col("_bytes").alias("bytes"),
        F.col("_shard_bytes").alias("shard_bytes"),
    )


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"), shingle=3, radius=2)
    return found.select("doc_id", simhash.fingerprint_text().alias("fingerprint"), "component_id")


def _span_text(spans: str):
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find_pii(read(spark, folder, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS
    ]
    return found.select(
        "doc_id", *counts, F.sha2(_span_text("base"), 256).alias("base_sha256"), _span_text("spans").alias("spans")
    )


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contained_items(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_found", "containment")


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    judged = urls.judge(read(spark, folder, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_repetition(spark: SparkSession, folder: str) -> DataFrame:
    found = repetition.repetition(read(spark, folder, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~F.col("repetitive")).alias("kept"),
    )


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_lang").alias("lang_pred"),
        F.col("_score").alias("score"), F.col("_ambiguous").alias("ambiguous"),
    )


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), F.col("_taken").alias("taken"),
    )


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.shared_passages(read(spark, folder, "documents"))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= TOXIC_FROM, 1).otherwise(0).cast("int").alias("predicted"),
    )


def op11_centroids(spark: SparkSession, folder: str) -> DataFrame:
    assigned, final = centroids.cluster(read(spark, folder, "embeddings"), k=40, dims=64, rounds=5, seed=2)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in final.tolist()]
    found = centroids.with_inertia(assigned)
    # One digest per centroid, in the plan as a literal.
    digest = F.element_at(F.array(*map(F.lit, digests)), F.col("cluster") + 1) if digests else F.lit("")
    return found.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", digest.alias("centroid_sha256")
    )


def op12_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = templates.extract(read(spark, folder, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    words = spelling.vocabulary(
        read(spark, folder, "documents"), min_length=7, min_count=2, noise=spelling.drop_by_checksum(31)
    )
    return spelling.variants(words, factor=10).select("word", "form", "root", "n", "n_near", "form_n")


def all_queries() -> dict[str, Query]:
    return {
        "op1_sharding": op1_sharding,
        "op2_simhash": op2_simhash,
        "op3_pii": op3_pii,
        "op4_decontamination": op4_decontamination,
        "op5_url_filters": op5_url_filters,
        "op6_repetition": op6_repetition,
        "op7_language_id": op7_language_id,
        "op8_mixing": op8_mixing,
        "op9_substring_dedup": op9_substring_dedup,
        "op10_toxicity": op10_toxicity,
        "op11_centroids": op11_centroids,
        "op12_extraction": op12_extraction,
        "op13_spelling": op13_spelling,
    }

"""Text to features: document, tokens, sentence vector."""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer, SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiltwatch.llm.common import drop_kept, keep
from tiltwatch.models.word_vectors import factorized, neighbour_counts, neighbour_rows, word_model

# Runs of letters and digits of any script are tokens.
TOKEN_GAP = r"[^\p{L}\p{N}]+"


def document_stage(text_col: str = "comment_text") -> Transformer:
    """``document``: the text, with NULL read as an empty document."""
    return SQLTransformer(
        statement=f"SELECT *, coalesce(`{text_col}`, '') AS document FROM __THIS__"
    )


def token_stage() -> Transformer:
    """``token``: lower-cased tokens of the whole document."""
    return RegexTokenizer(inputCol="document", outputCol="token", pattern=TOKEN_GAP)


def sentence_vector_stages(dimensions: int = 1 << 16, dense: bool = False) -> list[Transformer]:
    """``universal_embeddings``: a hashed token vector of fixed width.

    The width bounds driver and executor memory whatever the vocabulary, which a
    fitted vocabulary or word-vector table does not. ``dense`` counts tokens and
    scales to unit length, for small widths such as 512.
    """
    if not dense:
        return [
            HashingTF(
                inputCol="token",
                outputCol="universal_embeddings",
                numFeatures=dimensions,
                binary=True,
            )
        ]
    return [
        HashingTF(inputCol="token", outputCol="token_counts", numFeatures=dimensions),
        Normalizer(inputCol="token_counts", outputCol="universal_embeddings"),
        SQLTransformer(statement="SELECT * EXCEPT (token_counts) FROM __THIS__"),
    ]


# What hashed tokens leave out of a text, by column name.
TEXT_FEATURES = {
    "log_tokens": "ln(1D + size(token))",
    "distinct_share": "coalesce(try_divide(size(array_distinct(token)), size(token)), 1D)",
    "repeated_lines": "coalesce(1D - try_divide(size(array_distinct(text_lines)), size(text_lines)), 0D)",
    "symbol_share": r"""coalesce(try_divide(
        length(regexp_replace(document, '[\\p{L}\\p{N}\\s]', '')), length(document)), 0D)""",
    "mean_token": "coalesce(try_divide(length(array_join(token, '')), size(token)), 0D)",
}


def text_feature_stages() -> list[Transformer]:
    """One double column per entry of ``TEXT_FEATURES``; an empty text has fixed values."""
    lines = r"filter(split(document, '\\n'), x -> x != '')"
    columns = ", ".join(f"{formula} AS {name}" for name, formula in TEXT_FEATURES.items())
    return [
        SQLTransformer(statement=f"SELECT *, {lines} AS text_lines FROM __THIS__"),
        SQLTransformer(statement=f"SELECT * EXCEPT (text_lines), {columns} FROM __THIS__"),
    ]


def sentence_encoder(
    text_col: str = "comment_text", dimensions: int = 1 << 16, dense: bool = False
) -> PipelineModel:
    """All text stages as one transformer; none of them needs fitting."""
    return PipelineModel(
        [document_stage(text_col), token_stage(), *sentence_vector_stages(dimensions, dense)]
    )


def word_counts(tokens: DataFrame, min_count: int) -> DataFrame:
    """``(word, count)`` of the words that the column ``token`` has ``min_count`` times at least."""
    return tokens.select(F.explode("token").alias("word")).groupBy("word").count().filter(F.col("count") >= min_count)


def least_count(tokens: DataFrame, max_words: int, min_count: int) -> int:
    """The least count that at most ``max_words`` words of the column ``token`` reach, ``min_count`` at least.

    Counts are added up per task before they are shuffled; only the
    ``max_words`` + 1 largest are looked at together.
    """
    return _least(word_counts(tokens, min_count), max_words, min_count)


def _least(counts: DataFrame, max_words: int, min_count: int) -> int:
    top = counts.orderBy(F.desc("count")).limit(max_words + 1).agg(F.count("*").alias("n"), F.min("count").alias("least")).first()
    return min_count if top["n"] <= max_words else top["least"] + 1


def learned_encoder(
    docs: DataFrame,
    text_col: str = "comment_text",
    dimensions: int = 64,
    max_words: int = 20_000,
    min_count: int = 5,
    window: int = 5,
    passes: int = 5,
    seed: int = 0,
) -> PipelineModel:
    """Text stages whose ``universal_embeddings`` is the mean of word vectors learned from ``docs``.

    Words of like neighbours get like vectors, which hashed counts cannot give. The
    vocabulary is bounded by ``max_words``: rarer words raise the least count
    until it holds, so the table of vectors, on the driver and in every task,
    has ``max_words`` * ``dimensions`` floats at most. Every text is read
    whole and adds to the counts of words and to those of neighbours, on all cores. The vectors factorize
    the neighbours' mutual information, a matrix bounded by the vocabulary, in ``passes`` rounds (``word_vectors``).
    A text without a word of the vocabulary has
    the zero vector; NULL counts as empty. Without any frequent word there is nothing to learn, an error.
    """
    before = [document_stage(text_col), token_stage()]
    tokens = PipelineModel(before).transform(docs).select("token")
    counts = keep(word_counts(tokens, min_count), "word-counts")
    least = _least(counts, max_words, min_count)
    words = [r["word"] for r in counts.filter(F.col("count") >= least).orderBy(F.desc("count"), "word").collect()]
    drop_kept(counts)
    if not words:
        raise ValueError(f"no word occurs {least} times")
    rows = keep(neighbour_rows(neighbour_counts(tokens, words, window)), "neighbours")
    vectors = factorized(rows, len(words), dimensions, passes, seed)
    drop_kept(rows)
    names = dict(inputCol="token", outputCol="universal_embeddings", windowSize=window, seed=seed)
    return PipelineModel([*before, word_model(tokens, words, vectors, **names)])

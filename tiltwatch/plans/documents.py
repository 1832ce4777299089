"""Queries on labelled documents: label preparation, split, text and quality measures."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiltwatch.functions.labels import label_set, label_vector, prepare_labels
from tiltwatch.functions.split import hash_split, split_part
from tiltwatch.models.classifier import text_classifier, with_thresholds
from tiltwatch.models.text import document_stage, token_stage
from tiltwatch.operators.metrics import document_scores, label_scores, macro_f1
from tiltwatch.operators.thresholds import choose_thresholds
from tiltwatch.plans.reports import training_preview

COMMENT_LABELS = ("toxic", "low_quality")

# Words that stand in for a classifier where results must be exact.
WORDS = (
    "clown",
    "disgusting",
    "idiot",
    "loser",
    "moron",
    "pathetic",
    "scum",
    "stupid",
    "trash",
    "worthless",
)
WORD_PATTERN = f"(^|[^a-z])({'|'.join(WORDS)})([^a-z]|$)"
SHORT_TEXT = 300

_ROUNDED = 6


def comment_labels(comments: DataFrame) -> DataFrame:
    """Comments with ``labels`` and ``label_true`` for the two document labels."""
    return prepare_labels(comments, COMMENT_LABELS)


def fit_comments(comments: DataFrame) -> PipelineModel:
    """The document classifier, each label's threshold chosen on a sixth of ``comments`` that the fit leaves out."""
    fitting, choosing = hash_split(comments, "doc_id", (5, 1), salt="thresholds")
    model = text_classifier(COMMENT_LABELS, text_features=True).fit(fitting)
    scored = with_thresholds(model, dict.fromkeys(COMMENT_LABELS, -1.0)).transform(choosing)
    return with_thresholds(model, choose_thresholds(scored, F.col("class"), F.col("labels"), COMMENT_LABELS))


def first_comments(
    texts: DataFrame, flags: DataFrame, rows: int, toxic: int | None = None
) -> DataFrame:
    """A preview of ``texts`` joined to ``flags``, without shuffling the texts.

    The first keys are found on keys and flags alone; there are at most ``rows``
    of them, so they can be sent to where the texts lie.
    """
    known = flags.join(texts.select("doc_id"), "doc_id")
    keys = F.broadcast(training_preview(known, "doc_id", rows, toxic).select("doc_id").distinct())
    found = texts.join(keys, "doc_id", "left_semi").join(
        flags.join(keys, "doc_id", "left_semi"), "doc_id"
    )
    return training_preview(found, "doc_id", rows, toxic)


def split_parts(documents: DataFrame) -> DataFrame:
    """Each document's part of the 80/20 split."""
    part = split_part("doc_id", ("train", "validation"), (0.8, 0.2))
    return documents.select("doc_id", part.alias("part"))


def tokens(documents: DataFrame) -> DataFrame:
    """Whole documents as lower-cased tokens."""
    stages = PipelineModel([document_stage("text"), token_stage()])
    tokenised = stages.transform(documents.select("doc_id", "text"))
    return tokenised.select(
        "doc_id",
        F.size("token").alias("n_tokens"),
        F.array_join("token", " ").alias("tokens"),
    )


def word_model(text_col: str = "comment_text") -> PipelineModel:
    """A scoring model with exact results, in the shape of the trained one.

    Like the classifier it adds ``class``, an array of ``result`` and
    ``confidence``, so scoring code cannot tell the two apart.
    """
    statement = f"""
        SELECT *, filter(
            array(
                named_struct('result', 'toxic', 'confidence',
                    IF(lower(coalesce(`{text_col}`, '')) RLIKE '{WORD_PATTERN}', 1.0D, 0.0D)),
                named_struct('result', 'low_quality', 'confidence',
                    IF(length(coalesce(`{text_col}`, '')) < {SHORT_TEXT}, 1.0D, 0.0D))
            ),
            item -> item.confidence > 0.7D
        ) AS class
        FROM __THIS__
    """
    return PipelineModel([SQLTransformer(statement=statement)])


def word_predictions(documents: DataFrame, flags: DataFrame) -> DataFrame:
    """True and predicted label sets and vectors of the labelled documents.

    Documents are scored where they lie and only the short result is joined to
    ``flags``, so no text is shuffled.
    """
    scored = word_model("text").transform(documents.select("doc_id", "text"))
    predicted = scored.select("doc_id", F.col("class.result").alias("predicted"))
    return (
        comment_labels(flags)
        .join(predicted, "doc_id")
        .select(
            "doc_id",
            "labels",
            "label_true",
            "predicted",
            label_vector("predicted", COMMENT_LABELS).alias("label_pred"),
        )
    )


def prediction_vectors(documents: DataFrame, flags: DataFrame) -> DataFrame:
    predictions = word_predictions(documents, flags)

    def text(vector: str):
        return F.array_join(F.transform(vector, lambda x: x.cast("int").cast("string")), ",")

    return predictions.select(
        "doc_id", text("label_true").alias("truth"), text("label_pred").alias("prediction")
    )


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(f.name, _ROUNDED).alias(f.name) if f.dataType.typeName() == "double" else f.name
            for f in df.schema.fields
        ]
    )


def comment_label_scores(documents: DataFrame, flags: DataFrame) -> DataFrame:
    predictions = word_predictions(documents, flags)
    return _rounded(label_scores(predictions, "labels", "predicted", COMMENT_LABELS))


def comment_document_scores(documents: DataFrame, flags: DataFrame) -> DataFrame:
    predictions = word_predictions(documents, flags)
    return _rounded(document_scores(predictions, "labels", "predicted", COMMENT_LABELS))


def comment_macro_f1(documents: DataFrame, flags: DataFrame) -> DataFrame:
    predictions = word_predictions(documents, flags)
    return _rounded(macro_f1(label_scores(predictions, "labels", "predicted", COMMENT_LABELS)))


def label_set_of_flags(comments: DataFrame) -> DataFrame:
    """The label set alone, straight from the flags."""
    labels = label_set({x: F.col(x) == 1 for x in COMMENT_LABELS})
    return comments.select("doc_id", F.array_join(labels, ",").alias("labels"))

"""The four jobs from raw files to report tables, on named tables."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiltwatch.config import LABELS, Settings
from tiltwatch.functions.labels import prepare_labels
from tiltwatch.functions.split import hash_split
from tiltwatch.models.classifier import fit_report, text_classifier, with_thresholds
from tiltwatch.models.tracking import Run, load_model, register_model
from tiltwatch.operators.metrics import document_scores
from tiltwatch.operators.thresholds import choose_thresholds
from tiltwatch.plans import reports as R
from tiltwatch.plans.gold import GoldStates
from tiltwatch.schemas import TABLES
from tiltwatch.sources.split_csv import load_all
from tiltwatch.sources.tables import ensure_database, save_gold, save_table
from tiltwatch.streaming.batches import BatchTarget, score_into_batches
from tiltwatch.streaming.scoring import StreamTarget, score, score_stream, score_table

SCORED = "toxicity_chat_pred"
RUNS = "model_runs"
REGISTRY = "model_registry"


def load(spark: SparkSession, settings: Settings, folder: str) -> list[str]:
    """All CSV files of ``folder`` into typed tables."""
    ensure_database(spark, settings.database, settings.location)
    return load_all(spark, folder, settings.database)


def registry_folder(spark: SparkSession, settings: Settings) -> str:
    """The model registry lies beside the tables of the database."""
    rows = spark.sql(f"DESCRIBE DATABASE `{settings.database}`").filter("info_name = 'Location'")
    return f"{rows.select('info_value').first()[0].rstrip('/')}/_{REGISTRY}"


def _fitted(pipeline: Pipeline, fitting: DataFrame, choosing: DataFrame | None) -> tuple[PipelineModel, dict[str, float]]:
    """The fitted pipeline, with thresholds chosen on rows it has not seen if there are any."""
    model = pipeline.fit(fitting)
    if choosing is None:
        return model, {}
    open_model = with_thresholds(model, dict.fromkeys(LABELS, -1.0))
    scored = open_model.transform(choosing.withColumnRenamed("key", "comment_text"))
    chosen = choose_thresholds(scored, F.col("class"), F.col("labels"), LABELS)
    return with_thresholds(model, chosen), chosen


def train(
    spark: SparkSession,
    settings: Settings,
    model_root: str,
    stage: str | None = None,
    drop_unlabelled: bool = False,
    choose: bool = False,
    **model_settings,
) -> int:
    """Fit on 80 % of the comments, measure on the rest, register; returns the version.

    ``choose`` takes each label's threshold from the scores of an eighth of
    the 80 %, which the fit then leaves out; they are logged as parameters and loaded with the model.
    """
    comments = spark.table(settings.table(TABLES["train"]))
    prepared = prepare_labels(comments, LABELS, drop_unlabelled)
    if choose:
        fitting, choosing, validation = hash_split(prepared, "id", (0.7, 0.1, 0.2))
    else:
        (fitting, validation), choosing = hash_split(prepared, "id", (0.8, 0.2)), None
    with Run(spark, settings.table(RUNS), settings.model_name) as run:
        pipeline = text_classifier(LABELS, **model_settings)
        # What holds, given or by default.
        stage_settings = {
            p.name: v for s in pipeline.getStages() for p, v in getattr(s, "extractParamMap", dict)().items()
        }
        for name, value in (stage_settings | vars(pipeline.getStages()[-1]) | model_settings).items():
            if isinstance(value, (bool, int, float, str)) and not name.startswith("_"):
                run.log_param(name, value)
        run.log_param("labels", ",".join(LABELS))
        model, chosen = _fitted(pipeline, fitting, choosing)
        for label, threshold in chosen.items():
            run.log_param(f"threshold_{label}", threshold)
        for name, value in fit_report(model, pipeline.getStages()[-1].max_iter).items():
            run.log_metric(name, value)
        scored = score(validation, model)
        measures = document_scores(scored, "labels", "predicted").first().asDict()
        for name, value in measures.items():
            if value is not None:
                run.log_metric(name, value)
        return register_model(
            spark,
            model,
            settings.model_name,
            registry_folder(spark, settings),
            model_root,
            run.run_id,
            stage,
        )


def score_batch(
    spark: SparkSession,
    settings: Settings,
    stage: str | None = None,
    partitions: int | None = None,
) -> None:
    """Score all chat with the newest model."""
    model = load_model(spark, settings.model_name, registry_folder(spark, settings), stage)
    source, target = settings.table(TABLES["chat"]), settings.table(SCORED)
    score_table(spark, source, target, model, partitions)


def score_new(
    spark: SparkSession,
    settings: Settings,
    target: StreamTarget | BatchTarget,
    stage: str | None = None,
    files_per_batch: int | None = None,
):
    """Score the chat that came in since the last call; returns the streaming query.

    A :class:`BatchTarget` can be compacted at any time and feeds :func:`publish_new`.
    """
    model = load_model(spark, settings.model_name, registry_folder(spark, settings), stage)
    source = settings.table(TABLES["chat"])
    if isinstance(target, BatchTarget):
        return score_into_batches(spark, source, target, model, files_per_batch=files_per_batch)
    return score_stream(spark, source, target, model, files_per_batch=files_per_batch)


def reports(spark: SparkSession, settings: Settings, scored: str = SCORED) -> dict[str, DataFrame]:
    """Every report on the named tables, by name; until they are used, only the hot keys of the players are looked up."""
    chat = spark.table(settings.table(scored))
    players = spark.table(settings.table(TABLES["players"]))
    matches = spark.table(settings.table(TABLES["match"]))
    regions = spark.table(settings.table(TABLES["cluster_regions"]))
    joined = R.join_reports(R.seat_fold(chat), players, matches, regions, R.hot_players(players))
    return joined | {
        "toxic_vs_labelled": R.toxic_vs_labelled(chat),
        "toxic_split": R.toxic_split(chat),
        "messages_per_label": R.messages_per_label(chat),
        "label_count_histogram": R.label_count_histogram(chat),
        "match_share_per_label": R.match_share_per_label(chat),
        "toxic_timeline": R.toxic_timeline(chat),
        "toxic_timeline_disjoint": R.toxic_timeline_disjoint(chat),
    }


# Reports taken from the common message counts, with their column names.
_COUNTED = {
    "toxic_vs_labelled": ("label_type", "message_count"),
    "toxic_split": ("label_type", "message_count"),
    "messages_per_label": ("label_type", "message_count"),
    "toxic_timeline": ("timeline", "number_of_toxic_messages"),
    "toxic_timeline_disjoint": ("timeline", "number_of_toxic_messages"),
}


def publish(spark: SparkSession, settings: Settings, scored: str = SCORED) -> list[str]:
    """Save every report as a gold table; returns the table names.

    The reports that only count messages come from one scan of the chat, the six
    that join it to players from a second one, folded to one row per seat. Both
    results are kept while the tables are written.
    """
    chat = spark.table(settings.table(scored))
    own = {
        "label_count_histogram": R.label_count_histogram(chat),
        "match_share_per_label": R.match_share_per_label(chat),
    }
    return _save_reports(spark, settings, own, R.message_counts(chat), R.seat_fold(chat))


def publish_new(spark: SparkSession, settings: Settings, chat: BatchTarget, states: GoldStates) -> list[str]:
    """Bring the same gold tables up to date, reading only the chat that came in since the last call.

    ``chat`` is the target of a stream of scored messages, ``states`` holds what
    was folded of it so far. Players, matches and regions are read as they are now.
    """
    states.update(spark, chat)
    states.merge(spark)
    own = {
        "label_count_histogram": states.label_count_histogram(spark),
        "match_share_per_label": states.match_share_per_label(spark),
    }
    saved = _save_reports(spark, settings, own, states.total(spark, "counts"), states.total(spark, "seats"))
    states.clean(spark)
    return saved


def _save_reports(
    spark: SparkSession, settings: Settings, own: dict[str, DataFrame], counts: DataFrame, seats: DataFrame
) -> list[str]:
    """All reports as gold tables: those given, those in the message counts, and those that join seats to players."""
    players = spark.table(settings.table(TABLES["players"]))
    matches = spark.table(settings.table(TABLES["match"]))
    regions = spark.table(settings.table(TABLES["cluster_regions"]))
    kept = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return kept[-1]

    try:
        wanted = dict(own)
        counted = keep(counts)
        for name, columns in _COUNTED.items():
            rows = counted.filter(F.col("report") == name)
            wanted[name] = rows.select(*[F.col(a).alias(b) for a, b in zip(("name", "n"), columns)])
        hot = R.hot_players(players)
        wanted |= R.join_reports(keep(seats), players, matches, regions, hot)
        saved = []
        for name, report in wanted.items():
            table = settings.table(f"gold_{name}")
            save_gold(report, table)
            saved.append(table)
        return saved
    finally:
        for df in kept:
            df.unpersist()


def raw_activity(spark: SparkSession, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """Region activity and messages per account on chat that is not scored yet."""
    chat = spark.table(settings.table(TABLES["chat"])).withColumnRenamed("key", "comment_text")
    players = spark.table(settings.table(TABLES["players"]))
    matches = spark.table(settings.table(TABLES["match"]))
    regions = spark.table(settings.table(TABLES["cluster_regions"]))
    return (
        R.region_activity(chat, players, matches, regions),
        R.messages_per_account(chat, players),
    )


def preview(spark: SparkSession, settings: Settings, scored: str = SCORED) -> DataFrame:
    """Some ten scored messages, whichever come first: no scan of the whole table."""
    return spark.table(settings.table(scored)).limit(10)

"""Every runnable query by name, as ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiltwatch.config import work_folder
from tiltwatch.functions.labels import prepare_labels
from tiltwatch.models.text import learned_encoder, sentence_encoder
from tiltwatch.models.tracking import Run, load_model, move_stage, register_model, registered_models
from tiltwatch.operators.metrics import document_scores, label_scores
from tiltwatch.operators.range_counts import range_counts
from tiltwatch.plans import documents as D
from tiltwatch.plans import elementary as E
from tiltwatch.plans import reports as R
from tiltwatch.plans.gold import GoldStates
from tiltwatch.functions.split import hash_split
from tiltwatch.sources import star
from tiltwatch.sources.csv import load_csv, write_csv
from tiltwatch.sources.layout import ROW_GROUP_BYTES, SORT_BYTES, compact_files, fold_session, folder_bytes, scan_session
from tiltwatch.sources.split_csv import load_all, load_split_csv
from tiltwatch.sources.tables import append_evolving, ensure_database, save_gold, save_table
from tiltwatch.streaming.batches import BatchTarget, score_into_batches
from tiltwatch.streaming.scoring import StreamTarget, score, score_stream, score_table, wait

Query = Callable[[SparkSession, str], DataFrame]


def _folding(spark: SparkSession, folder: str) -> star.GameTables:
    """The tables for folds and joins by match and seat, whose tasks stay small however many seats there are."""
    return star.GameTables(fold_session(spark, folder_bytes(spark, f"{folder}/lineitem.parquet")), folder)


def _on_tables(function, *args) -> Query:
    """A report on ``(chat, players, matches, cluster_regions)``."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        t = _folding(spark, folder)
        return function(t.chat, t.players, t.matches, t.cluster_regions, *args)

    return query


def _on_players(function) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        t = _folding(spark, folder)
        return function(t.chat, t.players)

    return query


def _on_chat(function) -> Query:
    return lambda spark, folder: function(star.chat_pred(spark, folder))


def _on_game(function) -> Query:
    return lambda spark, folder: function(star.GameTables(spark, folder))


def _on_seats(function) -> Query:
    return lambda spark, folder: function(_folding(spark, folder))


def _on_training(function, *args) -> Query:
    return lambda spark, folder: function(star.training(spark, folder), *args)


def _on_comments(function) -> Query:
    return lambda spark, folder: function(star.comments(spark, folder))


def _on_judged(function) -> Query:
    """A query on all documents and the flags of the labelled ones."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        return function(star.read(spark, folder, "documents"), star.flags(spark, folder))

    return query


def _on_documents(function) -> Query:
    return lambda spark, folder: function(star.read(spark, folder, "documents"))


def _joined(df: DataFrame, *columns: str) -> DataFrame:
    """Array columns as comma-separated text, numbers without decimals."""

    def text(column: str):
        kind = df.schema[column].dataType.elementType.typeName()
        if kind == "string":
            return F.array_join(column, ",")
        return F.array_join(F.transform(column, lambda x: x.cast("int").cast("string")), ",")

    return df.withColumns({c: text(c) for c in columns})


def prepared_labels(spark: SparkSession, folder: str) -> DataFrame:
    return _joined(prepare_labels(star.training(spark, folder)), "labels", "label_true")


def prepared_labelled_only(spark: SparkSession, folder: str) -> DataFrame:
    prepared = prepare_labels(star.training(spark, folder), drop_unlabelled=True)
    return _joined(prepared, "labels", "label_true")


def prepared_comments(spark: SparkSession, folder: str) -> DataFrame:
    prepared = D.comment_labels(star.comments(spark, folder))
    return _joined(prepared, "labels", "label_true")


def predicted_preview(spark: SparkSession, folder: str) -> DataFrame:
    return _joined(R.predicted_preview(star.chat_pred(spark, folder)), "predicted")


def unlabelled_first(spark: SparkSession, folder: str) -> DataFrame:
    return E.filter_after_limit(D.comment_labels(star.comments(spark, folder)), "doc_id")


def _preview(rows: int, toxic: int | None = None) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return D.first_comments(star.texts(spark, folder), star.flags(spark, folder), rows, toxic)

    return query


def toxic_in_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The timeline with its ranges read from a table."""
    chat = star.chat_pred(spark, folder)
    toxic = chat.filter(F.array_contains("predicted", "toxic") & F.col("comment_text").isNotNull())
    return range_counts(toxic, "time", E.time_ranges(spark), count="n_messages")


def sql_table_scan(spark: SparkSession, folder: str) -> DataFrame:
    """A report written in SQL over named views."""
    star.matches(spark, folder).createOrReplaceTempView("tiltwatch_match")
    star.cluster_regions(spark, folder).createOrReplaceTempView("tiltwatch_cluster_regions")
    return spark.sql(
        """
        SELECT region, count(*) AS n_matches
        FROM Tiltwatch_match JOIN tiltwatch_cluster_regions USING (cluster)
        GROUP BY region
        """
    )


def csv_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents written as quoted multi-line CSV and loaded back with types."""
    documents = star.read(spark, folder, "documents").select("doc_id", "text", "lang", "n_chars")
    target = work_folder(spark, "csv")
    write_csv(documents, target)
    return load_csv(spark, target, documents.schema)


def split_csv_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every block of a mebibyte read by a task of its own."""
    documents = star.read(spark, folder, "documents").select("doc_id", "text", "lang", "n_chars")
    target = work_folder(spark, "csv")
    write_csv(documents, target)
    return load_split_csv(spark, target, documents.schema, split_bytes=1 << 20)


def _work_database(spark: SparkSession) -> str:
    """A new database in the shared work folder, for queries that need named tables."""
    name = f"tiltwatch_{uuid.uuid4().hex[:12]}"
    current = spark.catalog.currentDatabase()
    ensure_database(spark, name, work_folder(spark, "database"))
    spark.catalog.setCurrentDatabase(current)
    return name


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return star.read(spark, folder, "documents").select("doc_id", F.col("text").alias("key"))


def _shown(scored: DataFrame, *more: str) -> DataFrame:
    shown = scored.select("doc_id", F.length("comment_text").alias("n_chars"), *more, "predicted")
    return _joined(shown, "predicted")


def batch_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(score(_messages(spark, folder), D.word_model()))


def stream_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """A table of the documents read as a stream, scored into another, and read back."""
    database = _work_database(spark)
    save_table(_messages(spark, folder), f"{database}.chat")
    target = StreamTarget(f"{database}.scored", work_folder(spark, "checkpoint"))
    wait(score_stream(spark, f"{database}.chat", target, D.word_model()))
    return _shown(spark.table(target.table))


def stream_widened(spark: SparkSession, folder: str) -> DataFrame:
    """Short documents streamed without a language, then the others with one.

    The second run goes on from the first one's checkpoint; source and target
    get the new column, NULL in the rows that they held before.
    """
    database = _work_database(spark)
    source = f"{database}.chat"
    documents = star.read(spark, folder, "documents")
    short = F.coalesce(F.col("n_chars") < 1000, F.lit(True))
    columns = ["doc_id", F.col("text").alias("key")]
    save_table(documents.filter(short).select(*columns), source)
    target = StreamTarget(f"{database}.scored", work_folder(spark, "checkpoint"))
    wait(score_stream(spark, source, target, D.word_model()))
    append_evolving(spark, documents.filter(~short).select(*columns, "lang"), source)
    wait(score_stream(spark, source, target, D.word_model()))
    return _shown(spark.table(target.table), "lang")


def stream_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Documents streamed in batches into a target that is compacted between and after the runs."""
    database = _work_database(spark)
    source = f"{database}.chat"
    documents = star.read(spark, folder, "documents")
    short = F.coalesce(F.col("n_chars") < 1000, F.lit(True))
    columns = ["doc_id", F.col("text").alias("key")]
    save_table(documents.filter(short).select(*columns).repartition(3), source)
    target = BatchTarget(work_folder(spark, "batches"), work_folder(spark, "checkpoint"))
    wait(score_into_batches(spark, source, target, D.word_model(), files_per_batch=1))
    target.compact(spark)
    append_evolving(spark, documents.filter(~short).select(*columns), source)
    wait(score_into_batches(spark, source, target, D.word_model()))
    target.compact(spark, whole=True)
    target.clean(spark)
    return _shown(target.read(spark))


def registered_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """A registered model loaded again scores one table into another, which is read back."""
    database = _work_database(spark)
    registry = work_folder(spark, "registry")
    register_model(spark, D.word_model(), "words", registry, work_folder(spark, "models"))
    save_table(_messages(spark, folder), f"{database}.chat")
    model = load_model(spark, "words", registry)
    score_table(spark, f"{database}.chat", f"{database}.scored", model)
    return _shown(spark.table(f"{database}.scored"))


def repartitioned_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring behind a shuffle that spreads badly split input over as many tasks as shuffles use."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _shown(score(_messages(spark, folder), D.word_model(), tasks))


def gold_messages_per_label(spark: SparkSession, folder: str) -> DataFrame:
    """A report saved as a gold table and read back."""
    table = f"{_work_database(spark)}.gold_messages_per_label"
    save_gold(R.messages_per_label(star.chat_pred(spark, folder)), table)
    return spark.table(table)


def incremental_match_share(spark: SparkSession, folder: str) -> DataFrame:
    """Scored chat streamed in batches, folded as it comes in, compacted and folded on; the report is read off the folds."""
    chat = star.chat_pred(spark, folder).select("match_id", "slot", "time", "comment_text", "predicted")
    source = f"{_work_database(spark)}.chat"
    target = BatchTarget(work_folder(spark, "batches"), work_folder(spark, "checkpoint"))
    states = GoldStates(work_folder(spark, "states"))
    # Two batches each time, the first with two thirds of the files, of which there are more the larger the table.
    files = 3 * max(1, -(-folder_bytes(spark, f"{folder}/lineitem.parquet") // (3 * SORT_BYTES)))
    for early in (True, False):
        append_evolving(spark, chat.filter((F.col("time") < 600) == F.lit(early)).repartition(files), source)
        new = spark.readStream.option("maxFilesPerTrigger", files * 2 // 3).table(source)
        stream = new.writeStream.foreachBatch(target.write_batch).trigger(availableNow=True)
        wait(stream.option("checkpointLocation", target.checkpoint).start())
        states.update(spark, target)
        states.merge(spark)
        target.compact(spark)
    return states.match_share_per_label(spark)


def widened_union(spark: SparkSession, folder: str) -> DataFrame:
    """Lobby messages without a unit column joined on by the later, wider ones."""
    chat = star.chat(spark, folder)
    lobby = chat.filter(F.col("time") < 0).drop("unit")
    played = chat.filter(F.col("time") >= 0)
    return lobby.unionByName(played, allowMissingColumns=True)


# A table before compaction has so many files.
LOOSE_FILES = 64


def _compacted(cluster_by: tuple[str, ...], by_curve: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        chat = star.chat_pred(spark, folder).select("match_id", "slot", "time", "predicted")
        loose, tight = work_folder(spark, "loose"), work_folder(spark, "tight")
        chat.repartition(LOOSE_FILES).write.parquet(loose)
        compact_files(spark, loose, tight, cluster_by, by_curve=by_curve)
        # Nearly every row of a split may be a match for itself, so a task takes a row group or two.
        return R.match_share_per_label(scan_session(spark, ROW_GROUP_BYTES).read.parquet(tight))

    return query


# One fitted model per session and state of the input; fitting runs on the labelled part.
_MODELS: dict[tuple, object] = {}


def trained(spark: SparkSession, folder: str):
    """The document classifier, fitted when first asked for."""
    key = tuple(star.state(spark, folder, name) for name in ("documents", "labels"))
    if key not in _MODELS:
        train, _ = hash_split(D.comment_labels(star.comments(spark, folder)), "doc_id")
        _MODELS[key] = D.fit_comments(train)
    return _MODELS[key]


def learned_vector_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Width of every document's learned vector, and whether all its entries are finite."""
    documents = star.read(spark, folder, "documents").select("doc_id", "text")
    key = ("vectors", star.state(spark, folder, "documents"))
    if key not in _MODELS:
        _MODELS[key] = learned_encoder(documents, "text")
    vectors = _MODELS[key].transform(documents).select("doc_id", vector_to_array("universal_embeddings").alias("v"))
    finite = F.forall("v", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("doc_id", F.size("v").alias("width"), finite.alias("finite"))


def _documents_model(spark: SparkSession, folder: str) -> tuple[str, str]:
    """A database with a run log, and a registry with the document classifier in two versions, the first in production."""
    database, registry = _work_database(spark), work_folder(spark, "registry")
    root = work_folder(spark, "models")
    for version in (1, 2):
        with Run(spark, f"{database}.runs", "words") as run:
            run.log_param("words", len(D.WORDS))
            run.log_metric("documents", star.read(spark, folder, "documents").count())
            register_model(spark, D.word_model(), "words", registry, root, run.run_id, "Production" if version == 1 else None)
    return database, registry


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Two logged runs with what they were given and what they measured."""
    database, _ = _documents_model(spark, folder)
    return spark.table(f"{database}.runs").select(
        "experiment", "status", F.col("params")["words"].cast("int").alias("words"),
        F.col("metrics")["documents"].cast("long").alias("documents"),
        (F.col("ended") >= F.col("started")).alias("in_order"),
    )


def staged_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """The second version is moved to production, the first archived by that, and the model loaded by its stage scores."""
    _, registry = _documents_model(spark, folder)
    move_stage(spark, "words", registry, 2, "Production", alone=True)
    stages = {r["version"]: r["stage"] for r in registered_models(spark, registry).collect()}
    scored = _shown(score(_messages(spark, folder), load_model(spark, "words", registry, "Production")))
    return scored.select("*", F.lit(stages[1]).alias("first_stage"), F.lit(stages[2]).alias("second_stage"))


def fresh_stream(spark: SparkSession, folder: str) -> DataFrame:
    """A stream started over: old and new target side by side hold every document once each."""
    database = _work_database(spark)
    source = f"{database}.chat"
    save_table(_messages(spark, folder), source)
    old = StreamTarget(f"{database}.scored", work_folder(spark, "checkpoint"))
    fresh = old.fresh()
    for target in (old, old, fresh):
        wait(score_stream(spark, source, target, D.word_model()))
    both = spark.table(old.table).unionByName(spark.table(fresh.table))
    return both.groupBy("doc_id").agg(F.count("*").alias("copies"))


def loaded_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Several files loaded into their named tables, with the rows of each."""
    game = star.GameTables(spark, folder)
    raw, database = work_folder(spark, "raw"), _work_database(spark)
    given = {
        "chat": game.chat.select("match_id", F.col("comment_text").alias("key"), "slot", "time", "unit"),
        "players": game.players, "match": game.matches, "cluster_regions": game.cluster_regions,
    }
    for name, rows in given.items():
        write_csv(rows, f"{raw}/{name}.csv")
    tables = load_all(spark, raw, database, list(given))
    counts = [spark.table(t).agg(F.count("*").alias("n")).select(F.lit(t.split(".")[1]).alias("loaded"), "n") for t in tables]
    return functools.reduce(DataFrame.unionAll, counts)


def classified_documents(spark: SparkSession, folder: str) -> DataFrame:
    """All documents labelled by the trained classifier."""
    documents = star.read(spark, folder, "documents")
    scored = score(
        documents.select("doc_id", F.col("text").alias("key")), trained(spark, folder)
    )
    return _joined(scored.select("doc_id", "predicted"), "predicted")


def classifier_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Measures of the trained classifier on the held-out part."""
    _, validation = hash_split(D.comment_labels(star.comments(spark, folder)), "doc_id")
    scored = score(validation, trained(spark, folder))
    return document_scores(scored, "labels", "predicted", D.COMMENT_LABELS)


def _label_quality(spark: SparkSession, folder: str) -> DataFrame:
    _, validation = hash_split(D.comment_labels(star.comments(spark, folder)), "doc_id")
    scored = score(validation, trained(spark, folder))
    return label_scores(scored, "labels", "predicted", D.COMMENT_LABELS)


def classifier_support(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out documents that carry each label, as the classifier's measures count them."""
    return _label_quality(spark, folder).select("label", (F.col("tp") + F.col("fn")).alias("documents"))


def classifier_beats_chance(spark: SparkSession, folder: str) -> DataFrame:
    """Per label, whether the trained classifier's F1 on held-out documents is above that of giving the label to all."""
    _, validation = hash_split(D.comment_labels(star.comments(spark, folder)), "doc_id")
    documents = validation.agg(F.count("*").alias("n")).select("n").scalar()
    carried = F.col("tp") + F.col("fn")
    given_to_all = F.try_divide(2 * carried, carried + documents)
    return _label_quality(spark, folder).select("label", (F.col("f1") > given_to_all).alias("beats_chance"))


def sentence_vector_norms(spark: SparkSession, folder: str) -> DataFrame:
    """Width and length of every document's sentence vector."""
    vectors = sentence_vectors(spark, folder)
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x)
    return vectors.select(
        "doc_id", F.size("embedding").alias("width"), F.round(F.sqrt(squares), 6).alias("norm")
    )


def sentence_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """A 512-wide unit vector per document, as an array."""
    documents = star.read(spark, folder, "documents").select("doc_id", "text")
    encoded = sentence_encoder("text", 512, dense=True).transform(documents)
    return encoded.select("doc_id", vector_to_array("universal_embeddings").alias("embedding"))


def all_queries() -> dict[str, Query]:
    return {
        # Reports
        "region_activity": _on_tables(R.region_activity),
        "region_activity_authored": _on_tables(R.region_activity_authored),
        "messages_per_account": _on_players(R.messages_per_account),
        "toxic_regions_top5": _on_tables(R.toxic_regions),
        "toxic_regions_authored": _on_tables(R.toxic_regions_authored),
        "toxic_vs_labelled": _on_chat(R.toxic_vs_labelled),
        "toxic_split": _on_chat(R.toxic_split),
        "messages_per_label": _on_chat(R.messages_per_label),
        "label_count_histogram": _on_chat(R.label_count_histogram),
        "match_share_per_label": _on_chat(R.match_share_per_label),
        "toxic_timeline": _on_chat(R.toxic_timeline),
        "toxic_timeline_disjoint": _on_chat(R.toxic_timeline_disjoint),
        "message_counts": _on_chat(R.message_counts),
        "toxic_players_top10": _on_players(R.toxic_players),
        "training_preview": _preview(10),
        "training_preview_clean": _preview(1, 0),
        "training_preview_toxic": _preview(1, 1),
        "predicted_preview": predicted_preview,
        # Label preparation, split and measures
        "prepared_labels": prepared_labels,
        "prepared_labelled_only": prepared_labelled_only,
        "prepared_comments": prepared_comments,
        "unlabelled_first": unlabelled_first,
        "label_set_of_flags": _on_comments(D.label_set_of_flags),
        "train_validation_split": _on_documents(D.split_parts),
        "prediction_vectors": _on_judged(D.prediction_vectors),
        "multilabel_label_scores": _on_judged(D.comment_label_scores),
        "multilabel_document_scores": _on_judged(D.comment_document_scores),
        "multilabel_macro_f1": _on_judged(D.comment_macro_f1),
        # Text and classifier
        "document_tokens": _on_documents(D.tokens),
        "sentence_vectors": sentence_vectors,
        "classified_documents": classified_documents,
        "classifier_quality": classifier_quality,
        "classifier_label_quality": _label_quality,
        "classifier_support": classifier_support,
        "classifier_beats_chance": classifier_beats_chance,
        "sentence_vector_norms": sentence_vector_norms,
        "learned_vector_shapes": learned_vector_shapes,
        # Sources, sinks, streams and layout
        "sql_table_scan": sql_table_scan,
        "csv_documents": csv_documents,
        "split_csv_documents": split_csv_documents,
        "batch_scoring": batch_scoring,
        "stream_scoring": stream_scoring,
        "stream_compacted": stream_compacted,
        "stream_widened": stream_widened,
        "registered_scoring": registered_scoring,
        "staged_scoring": staged_scoring,
        "run_log": run_log,
        "fresh_stream": fresh_stream,
        "loaded_tables": loaded_tables,
        "repartitioned_scoring": repartitioned_scoring,
        "gold_messages_per_label": gold_messages_per_label,
        "incremental_match_share": incremental_match_share,
        "widened_union": widened_union,
        "compacted_match_share": _compacted(()),
        "clustered_match_share": _compacted(("match_id",)),
        "zordered_match_share": _compacted(("match_id", "time"), by_curve=True),
        # Projections
        "select_all": _on_game(E.select_all),
        "select_expressions": _on_game(E.select_expressions),
        "rename_columns": _on_training(E.rename_columns),
        "add_columns": _on_game(E.add_columns),
        "drop_columns": _on_game(E.drop_columns),
        "array_constructor": _on_training(E.array_constructor),
        "nested_field": _on_game(E.nested_field),
        "constant_column": _on_game(E.constant_column),
        "inline_view": _on_game(E.inline_view),
        "scalar_subquery": _on_game(E.scalar_subquery),
        # Predicates
        "string_flag_equality": _on_training(E.string_flag_equality),
        "case_on_flag": _on_training(E.case_on_flag),
        "array_membership": _on_game(E.array_membership),
        "array_empty": _on_game(E.array_empty),
        "time_comparison": _on_game(E.time_comparison),
        "time_between": _on_game(E.time_between),
        "conjunction": _on_game(E.conjunction),
        # Joins
        "match_join_pairs": _on_game(E.match_join_pairs),
        "players_with_match": _on_game(E.players_with_match),
        "match_with_region": _on_game(E.match_with_region),
        "authored_messages": _on_seats(E.authored_messages),
        "four_table_join": _on_seats(E.four_table_join),
        # Aggregates
        "group_by_column": _on_game(E.group_by_column),
        "group_by_expression": _on_game(E.group_by_expression),
        "global_aggregate": _on_game(E.global_aggregate),
        "count_variants": _on_game(E.count_variants),
        "count_distinct": _on_game(E.count_distinct),
        "seat_message_counts": _on_seats(E.seat_message_counts),
        "toxic_in_ranges": toxic_in_ranges,
        # Sorting, limits, set operations
        "sort_by_count": _on_game(E.sort_by_count),
        "sort_by_hidden_count": _on_game(E.sort_by_hidden_count),
        "sort_by_group": _on_game(E.sort_by_group),
        "limit_rows": _on_game(E.limit_rows),
        "top_units": _on_game(E.top_units),
        "union_of_counts": _on_game(E.union_of_counts),
        "union_of_times": _on_game(E.union_of_times),
        "union_of_matches": _on_game(E.union_of_matches),
        # Scalar functions
        "label_array_functions": _on_training(E.label_array_functions),
        "cast_flags": _on_training(E.cast_flags),
        "round_and_divide": _on_game(E.round_and_divide),
        "string_number_comparison": _on_training(E.string_number_comparison),
    }

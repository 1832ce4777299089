"""The same queries in SQL, written the direct way, to compare results with."""

from __future__ import annotations

from tiltwatch.config import LABELS, display_name
from tiltwatch.plans.documents import SHORT_TEXT, WORD_PATTERN

_FLAGS = {
    "toxic": "l_returnflag = 'R'",
    "severe_toxic": "l_returnflag = 'R' AND l_discount >= 0.09",
    "obscene": "l_returnflag = 'R' AND l_tax >= 0.06",
    "threat": "l_returnflag = 'R' AND l_quantity >= 48",
    "insult": "l_linestatus = 'F' AND l_quantity >= 40",
    "identity_hate": "l_returnflag = 'R' AND l_quantity <= 2",
}

_MESSAGE = """l_orderkey AS match_id, l_linenumber AS slot,
    (l_orderkey * 7 + l_partkey * 13 + l_linenumber) % 3000 - 300 AS time,
    CASE WHEN l_quantity = 7 THEN NULL ELSE 'msg ' || l_partkey END AS comment_text"""

_PREDICTED = "list_filter([{}], lambda x: x IS NOT NULL)".format(
    ", ".join(f"CASE WHEN {cond} THEN '{label}' END" for label, cond in _FLAGS.items())
)

_VIEWS = {
    "chat": f"SELECT {_MESSAGE}, 'u' || l_suppkey AS unit, {_PREDICTED} AS predicted FROM lineitem",
    "training": f"SELECT {_MESSAGE}, "
    + ", ".join(f"CASE WHEN {c} THEN '1' ELSE '0' END AS {x}" for x, c in _FLAGS.items())
    + " FROM lineitem",
    "players": """SELECT l_orderkey AS match_id, l_linenumber AS player_slot,
        min(l_suppkey) AS account_id FROM lineitem GROUP BY 1, 2""",
    "matches": "SELECT o_orderkey AS match_id, o_custkey % 25 AS cluster FROM orders",
    "cluster_regions": """SELECT n_nationkey AS cluster, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "comments": """SELECT doc_id, text AS comment_text, toxic, 1 - quality AS low_quality
        FROM documents JOIN labels USING (doc_id)""",
    "judged": f"""SELECT doc_id, toxic = 1 AS t_toxic, low_quality = 1 AS t_low,
        regexp_matches(lower(coalesce(comment_text, '')), '{WORD_PATTERN}') AS p_toxic,
        length(coalesce(comment_text, '')) < {SHORT_TEXT} AS p_low FROM comments""",
}

_NEEDS = {"judged": ("comments",)}


def _with(views: str, query: str) -> str:
    names = []
    for view in views.split():
        names += [n for n in (*_NEEDS.get(view, ()), view) if n not in names]
    return "WITH " + ", ".join(f"{n} AS ({_VIEWS[n]})" for n in names) + "\n" + query


_FANOUT = """FROM chat JOIN players ON chat.match_id = players.match_id
    JOIN matches ON matches.match_id = players.match_id
    JOIN cluster_regions ON matches.cluster = cluster_regions.cluster"""

_AUTHORED = """FROM chat JOIN players
    ON chat.match_id = players.match_id AND chat.slot = players.player_slot"""

_LOCATED = f"""{_AUTHORED} JOIN matches ON matches.match_id = players.match_id
    JOIN cluster_regions ON matches.cluster = cluster_regions.cluster"""

_REGION_COLUMNS = """region, count(DISTINCT account_id) AS n_players,
    count(comment_text) AS n_messages"""

_TOXIC = "list_contains(predicted, 'toxic')"

_GAME = "chat players matches cluster_regions"


def _label_union(select: str, source: str = "chat") -> str:
    return " UNION ".join(
        f"SELECT '{display_name(x)}' AS label_type, {select} FROM {source} "
        f"WHERE list_contains(predicted, '{x}')"
        for x in LABELS
    )


def _time_union(spans: dict[str, str]) -> str:
    return " UNION ".join(
        f"SELECT '{name}' AS timeline, count(comment_text) AS number_of_toxic_messages "
        f"FROM chat WHERE {_TOXIC} AND {where}"
        for name, where in spans.items()
    )


_OVERLAPPING = {
    "Game_Lobby": "time < 0",
    "Less_Than_5_minutes": "time < 300",
    "5-10_minutes": "time BETWEEN 300 AND 600",
    "10-20_minutes": "time BETWEEN 600 AND 1200",
    "20-30_minutes": "time BETWEEN 1200 AND 1800",
    "30-40_minutes": "time BETWEEN 1800 AND 2400",
    "40+minutes": "time > 2400",
}

_DISJOINT = {
    "Game_Lobby": "time < 0",
    "Less_Than_5_minutes": "time >= 0 AND time < 300",
    "5-10_minutes": "time >= 300 AND time < 600",
    "10-20_minutes": "time >= 600 AND time < 1200",
    "20-30_minutes": "time >= 1200 AND time < 1800",
    "30-40_minutes": "time >= 1800 AND time < 2400",
    "40+minutes": "time >= 2400",
}

_MATCH_SHARE = f"""SELECT label_type, match_count,
    round(match_count / (SELECT count(DISTINCT match_id) FROM chat) * 100)
        AS percent_of_total_matches
    FROM ({_label_union("count(DISTINCT match_id) AS match_count")})"""

_TRUE_COLUMNS = ", ".join(f"{x} AS {x}_true" for x in LABELS)
_LABELS_TEXT = "array_to_string(list_filter([{}], lambda x: x IS NOT NULL), ',')".format(
    ", ".join(f"CASE WHEN {x} = '1' THEN '{x}' END" for x in LABELS)
)
_VECTOR_TEXT = "array_to_string([{}], ',')".format(", ".join(LABELS))
_PREPARED = f"""SELECT match_id, slot, time, comment_text, {_TRUE_COLUMNS},
    {_LABELS_TEXT} AS labels, {_VECTOR_TEXT} AS label_true FROM training"""

_COMMENT_LABELS = """array_to_string(list_filter([
    CASE WHEN toxic = 1 THEN 'toxic' END,
    CASE WHEN low_quality = 1 THEN 'low_quality' END], lambda x: x IS NOT NULL), ',')"""

_SCORED = f"""SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars,
    array_to_string(list_filter([
        CASE WHEN regexp_matches(lower(coalesce(text, '')), '{WORD_PATTERN}') THEN 'toxic' END,
        CASE WHEN length(coalesce(text, '')) < {SHORT_TEXT} THEN 'low_quality' END],
        lambda x: x IS NOT NULL), ',') AS predicted
    FROM documents"""

_LABEL_SCORES = """SELECT label, tp, fp, fn,
    CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
    CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
    CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1
    FROM (
        SELECT 'toxic' AS label, count(*) FILTER (t_toxic AND p_toxic) AS tp,
            count(*) FILTER (NOT t_toxic AND p_toxic) AS fp,
            count(*) FILTER (t_toxic AND NOT p_toxic) AS fn FROM judged
        UNION ALL
        SELECT 'low_quality', count(*) FILTER (t_low AND p_low),
            count(*) FILTER (NOT t_low AND p_low),
            count(*) FILTER (t_low AND NOT p_low) FROM judged)"""

_DOCUMENT_SCORES = """SELECT count(*) AS documents,
    round(avg(CASE WHEN both_n = t_n AND both_n = p_n THEN 1.0::DOUBLE ELSE 0 END), 6)
        AS subset_accuracy,
    round(avg(CASE WHEN t_n + p_n = 0 THEN 1.0::DOUBLE ELSE both_n / (t_n + p_n - both_n) END), 6)
        AS accuracy,
    round(avg((t_n + p_n - 2 * both_n) / 2), 6) AS hamming_loss,
    round(avg(CASE WHEN t_n + p_n = 0 THEN 1.0::DOUBLE WHEN p_n = 0 THEN 0
        ELSE both_n / p_n END), 6) AS precision,
    round(avg(CASE WHEN t_n + p_n = 0 THEN 1.0::DOUBLE WHEN t_n = 0 THEN 0
        ELSE both_n / t_n END), 6) AS recall,
    round(avg(CASE WHEN t_n + p_n = 0 THEN 1.0::DOUBLE ELSE 2 * both_n / (t_n + p_n) END), 6)
        AS f1,
    round(CASE WHEN sum(p_n) = 0 THEN 0 ELSE sum(both_n) / sum(p_n) END, 6) AS micro_precision,
    round(CASE WHEN sum(t_n) = 0 THEN 0 ELSE sum(both_n) / sum(t_n) END, 6) AS micro_recall,
    round(CASE WHEN sum(t_n + p_n) = 0 THEN 0 ELSE 2 * sum(both_n) / sum(t_n + p_n) END, 6)
        AS micro_f1,
    round(avg(1 - abs(t_n - p_n) / 2), 6) AS agreement_f1
    FROM (SELECT t_toxic::INT + t_low::INT AS t_n, p_toxic::INT + p_low::INT AS p_n,
        (t_toxic AND p_toxic)::INT + (t_low AND p_low)::INT AS both_n FROM judged)"""


def all_sql() -> dict[str, str]:
    return {
        # Reports
        "region_activity": _with(_GAME, f"SELECT {_REGION_COLUMNS} {_FANOUT} GROUP BY region"),
        "region_activity_authored": _with(
            _GAME, f"SELECT {_REGION_COLUMNS} {_LOCATED} GROUP BY region"
        ),
        "messages_per_account": _with(
            "chat players",
            f"SELECT account_id, count(comment_text) AS n_messages {_AUTHORED} GROUP BY account_id",
        ),
        "toxic_regions_top5": _with(
            _GAME,
            f"""SELECT {_REGION_COLUMNS} {_FANOUT} WHERE {_TOXIC} GROUP BY region
            ORDER BY count(account_id) DESC, region LIMIT 5""",
        ),
        "toxic_regions_authored": _with(
            _GAME,
            f"""SELECT {_REGION_COLUMNS} {_LOCATED} WHERE {_TOXIC} GROUP BY region
            ORDER BY count(account_id) DESC, region LIMIT 5""",
        ),
        "toxic_vs_labelled": _with(
            "chat",
            f"""SELECT 'Toxic' AS label_type, count(*) AS message_count FROM chat WHERE {_TOXIC}
            UNION SELECT 'Non-Toxic', count(*) FROM chat WHERE len(predicted) > 0""",
        ),
        "toxic_split": _with(
            "chat",
            f"""SELECT CASE WHEN {_TOXIC} THEN 'Toxic' ELSE 'Non-Toxic' END AS label_type,
            count(*) AS message_count FROM chat GROUP BY 1""",
        ),
        "messages_per_label": _with("chat", _label_union("count(*) AS message_count")),
        "label_count_histogram": _with(
            "chat",
            """SELECT CAST(len(predicted) AS INTEGER) AS number_of_labels,
            count(*) AS message_count FROM chat WHERE len(predicted) > 0 GROUP BY 1 ORDER BY 1""",
        ),
        "match_share_per_label": _with("chat", _MATCH_SHARE),
        "toxic_timeline": _with("chat", _time_union(_OVERLAPPING)),
        "toxic_timeline_disjoint": _with("chat", _time_union(_DISJOINT)),
        "message_counts": _with(
            "chat",
            f"""SELECT 'toxic_vs_labelled' AS report, 'Toxic' AS name, count(*) AS n
                FROM chat WHERE {_TOXIC}
            UNION SELECT 'toxic_vs_labelled', 'Non-Toxic', count(*)
                FROM chat WHERE len(predicted) > 0
            UNION SELECT 'toxic_split', CASE WHEN {_TOXIC} THEN 'Toxic' ELSE 'Non-Toxic' END,
                count(*) FROM chat GROUP BY 2
            UNION SELECT 'messages_per_label', * FROM ({_label_union("count(*) AS n")})
            UNION SELECT 'toxic_timeline', * FROM ({_time_union(_OVERLAPPING)})
            UNION SELECT 'toxic_timeline_disjoint', * FROM ({_time_union(_DISJOINT)})""",
        ),
        "toxic_players_top10": _with(
            "chat players",
            f"""SELECT account_id, count(comment_text) AS n_messages {_AUTHORED}
            WHERE {_TOXIC} GROUP BY account_id ORDER BY 2 DESC, account_id LIMIT 10""",
        ),
        "training_preview": _with("comments", "SELECT * FROM comments ORDER BY doc_id LIMIT 10"),
        "training_preview_clean": _with(
            "comments", "SELECT * FROM comments WHERE toxic = 0 ORDER BY doc_id LIMIT 1"
        ),
        "training_preview_toxic": _with(
            "comments", "SELECT * FROM comments WHERE toxic = 1 ORDER BY doc_id LIMIT 1"
        ),
        "predicted_preview": _with(
            "chat",
            """SELECT match_id, comment_text, slot, time, unit,
            array_to_string(predicted, ',') AS predicted FROM chat
            ORDER BY match_id, comment_text NULLS FIRST, slot, time, unit, predicted LIMIT 10""",
        ),
        # Label preparation, split and measures
        "prepared_labels": _with("training", _PREPARED),
        "prepared_labelled_only": _with(
            "training", f"SELECT * FROM ({_PREPARED}) WHERE labels <> ''"
        ),
        "prepared_comments": _with(
            "comments",
            f"""SELECT doc_id, comment_text, toxic AS toxic_true, low_quality AS low_quality_true,
            {_COMMENT_LABELS} AS labels,
            array_to_string([toxic, low_quality], ',') AS label_true FROM comments""",
        ),
        "unlabelled_first": _with(
            "comments",
            """SELECT doc_id, 0 AS n_labels
            FROM (SELECT * FROM comments ORDER BY doc_id LIMIT 1)
            WHERE toxic <> 1 AND low_quality <> 1""",
        ),
        "label_set_of_flags": _with(
            "comments", f"SELECT doc_id, {_COMMENT_LABELS} AS labels FROM comments"
        ),
        "train_validation_split": """SELECT doc_id, CASE WHEN
            ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT < 3435973836
            THEN 'train' ELSE 'validation' END AS part FROM documents""",
        "prediction_vectors": _with(
            "judged",
            """SELECT doc_id, array_to_string([t_toxic::INT, t_low::INT], ',') AS truth,
            array_to_string([p_toxic::INT, p_low::INT], ',') AS prediction FROM judged""",
        ),
        "multilabel_label_scores": _with(
            "judged",
            f"""SELECT label, tp, fp, fn, round(precision, 6) AS precision,
            round(recall, 6) AS recall, round(f1, 6) AS f1 FROM ({_LABEL_SCORES})""",
        ),
        "multilabel_document_scores": _with("judged", _DOCUMENT_SCORES),
        "multilabel_macro_f1": _with(
            "judged", f"SELECT round(avg(f1), 6) AS macro_f1 FROM ({_LABEL_SCORES})"
        ),
        # Text
        "document_tokens": r"""SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens,
            array_to_string(t, ' ') AS tokens FROM (
                SELECT doc_id, list_filter(
                    regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
                    lambda x: x <> '') AS t FROM documents)""",
        # Sources, sinks, streams and layout
        "sql_table_scan": _with(
            "matches cluster_regions",
            """SELECT region, count(*) AS n_matches FROM matches JOIN cluster_regions
            USING (cluster) GROUP BY region""",
        ),
        "csv_documents": "SELECT doc_id, text, lang, n_chars FROM documents",
        "split_csv_documents": "SELECT doc_id, text, lang, n_chars FROM documents",
        "batch_scoring": _SCORED,
        "stream_scoring": _SCORED,
        "stream_compacted": _SCORED,
        "stream_widened": f"""SELECT scored.*, CASE WHEN documents.n_chars >= 1000 THEN lang END AS lang
            FROM ({_SCORED}) scored JOIN documents USING (doc_id)""",
        "registered_scoring": _SCORED,
        "staged_scoring": f"SELECT *, 'Archived' AS first_stage, 'Production' AS second_stage FROM ({_SCORED})",
        "run_log": """SELECT 'words' AS experiment, 'finished' AS status, 10 AS words,
            (SELECT count(*) FROM documents) AS documents, true AS in_order FROM range(2)""",
        "fresh_stream": "SELECT doc_id, 2 * count(*) AS copies FROM documents GROUP BY doc_id",
        "loaded_tables": _with(
            "chat players matches cluster_regions",
            """SELECT 'toxicity_chat' AS loaded, count(*) AS n FROM chat
            UNION ALL SELECT 'toxicity_players', count(*) FROM players
            UNION ALL SELECT 'toxicity_match', count(*) FROM matches
            UNION ALL SELECT 'toxicity_cluster_regions', count(*) FROM cluster_regions""",
        ),
        "learned_vector_shapes": "SELECT doc_id, 64 AS width, true AS finite FROM documents",
        "repartitioned_scoring": _SCORED,
        "gold_messages_per_label": _with("chat", _label_union("count(*) AS message_count")),
        "sentence_vector_norms": r"""SELECT doc_id, 512 AS width,
            CASE WHEN regexp_matches(coalesce(text, ''), '[\p{L}\p{N}]') THEN 1.0::DOUBLE
            ELSE 0.0::DOUBLE END AS norm FROM documents""",
        "classifier_support": _with(
            "comments",
            """SELECT label, count(*) FILTER (flag = 1) AS documents FROM (
            SELECT 'toxic' AS label, toxic AS flag, doc_id FROM comments
            UNION ALL SELECT 'low_quality', low_quality, doc_id FROM comments)
            WHERE ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT >= 3435973836
            GROUP BY label""",
        ),
        "classifier_beats_chance": """SELECT label, true AS beats_chance
            FROM (SELECT unnest(['toxic', 'low_quality']) AS label)
            WHERE EXISTS (SELECT 1 FROM labels WHERE toxic = 1 AND label = 'toxic' OR quality = 0 AND label = 'low_quality')""",
        "widened_union": _with(
            "chat",
            """SELECT match_id, slot, time, comment_text AS key,
            CASE WHEN time >= 0 THEN unit END AS unit FROM chat""",
        ),
        "compacted_match_share": _with("chat", _MATCH_SHARE),
        "clustered_match_share": _with("chat", _MATCH_SHARE),
        "zordered_match_share": _with("chat", _MATCH_SHARE),
        "incremental_match_share": _with("chat", _MATCH_SHARE),
        # Projections
        "select_all": _with("matches", "SELECT * FROM matches"),
        "select_expressions": _with(
            "chat",
            "SELECT match_id, slot, time + 300 AS since_lobby, upper(unit) AS who FROM chat",
        ),
        "rename_columns": _with(
            "training",
            f"SELECT match_id, slot, time, comment_text, {_TRUE_COLUMNS} FROM training",
        ),
        "add_columns": _with(
            "chat",
            """SELECT match_id, slot, time, comment_text IS NOT NULL AS has_text,
            CAST(len(predicted) AS INTEGER) AS number_of_labels FROM chat""",
        ),
        "drop_columns": _with("chat", "SELECT match_id, slot, time, comment_text, unit FROM chat"),
        "array_constructor": _with(
            "training", f"SELECT match_id, slot, time, {_VECTOR_TEXT} AS flags FROM training"
        ),
        "nested_field": _with(
            "chat",
            """SELECT match_id, slot, time, array_to_string(list_transform(
                list_transform(predicted, lambda x: {'result': x, 'confidence': length(x)}),
                lambda s: s.result), ',') AS results FROM chat""",
        ),
        "constant_column": _with(
            "chat",
            f"SELECT 'Toxic' AS label_type, count(*) AS message_count FROM chat WHERE {_TOXIC}",
        ),
        "inline_view": _with(
            "chat",
            f"""SELECT label_type AS kind, message_count * 2 AS twice FROM (
            SELECT 'Toxic' AS label_type, count(*) AS message_count FROM chat WHERE {_TOXIC})""",
        ),
        "scalar_subquery": _with(
            "cluster_regions",
            """SELECT region, count(DISTINCT cluster) AS clusters,
            round(count(DISTINCT cluster) /
                (SELECT count(DISTINCT cluster) FROM cluster_regions) * 100) AS percent
            FROM cluster_regions GROUP BY region""",
        ),
        # Predicates
        "string_flag_equality": _with(
            "training", "SELECT match_id, slot, time, comment_text FROM training WHERE toxic = 1"
        ),
        "case_on_flag": _with(
            "training",
            """SELECT match_id, slot, time,
            CASE WHEN toxic = '1' THEN 'toxic' ELSE '0' END AS toxic FROM training""",
        ),
        "array_membership": _with(
            "chat",
            """SELECT match_id, slot, time, comment_text FROM chat
            WHERE list_contains(predicted, 'insult')""",
        ),
        "array_empty": _with(
            "chat",
            """SELECT 'empty' AS kind, count(*) AS n FROM chat WHERE len(predicted) = 0
            UNION ALL SELECT 'filled', count(*) FROM chat WHERE len(predicted) > 0""",
        ),
        "time_comparison": _with(
            "chat", "SELECT match_id, slot, time, comment_text FROM chat WHERE time > 2400"
        ),
        "time_between": _with(
            "chat",
            "SELECT match_id, slot, time, comment_text FROM chat WHERE time BETWEEN 300 AND 600",
        ),
        "conjunction": _with(
            "chat",
            f"SELECT match_id, slot, time, comment_text FROM chat WHERE {_TOXIC} AND time < 0",
        ),
        # Joins
        "match_join_pairs": _with(
            "chat players",
            """SELECT chat.match_id, count(*) AS pairs FROM chat JOIN players
            ON chat.match_id = players.match_id GROUP BY 1""",
        ),
        "players_with_match": _with(
            "players matches",
            """SELECT match_id, player_slot, account_id, cluster, 1::BIGINT AS copies
            FROM players JOIN matches USING (match_id)""",
        ),
        "match_with_region": _with(
            "matches cluster_regions",
            "SELECT match_id, cluster, region FROM matches JOIN cluster_regions USING (cluster)",
        ),
        "authored_messages": _with(
            "chat players",
            f"SELECT chat.match_id, slot, time, comment_text, account_id {_AUTHORED}",
        ),
        "four_table_join": _with(
            _GAME,
            f"SELECT chat.match_id, region, count(*) AS joined_rows {_FANOUT} GROUP BY 1, 2",
        ),
        # Aggregates
        "group_by_column": _with(
            "players", "SELECT account_id, count(*) AS seats FROM players GROUP BY account_id"
        ),
        "group_by_expression": _with(
            "chat",
            """SELECT CAST(len(predicted) AS INTEGER) AS number_of_labels,
            count(*) AS message_count FROM chat GROUP BY 1""",
        ),
        "global_aggregate": _with(
            "chat",
            """SELECT count(*) AS message_count FROM chat
            WHERE list_contains(predicted, 'no such label')""",
        ),
        "count_variants": _with(
            "chat",
            f"""SELECT count(*) AS messages, count(comment_text) AS with_text,
            count(*) FILTER ({_TOXIC}) AS toxic FROM chat""",
        ),
        "count_distinct": _with(
            "players",
            """SELECT 'accounts' AS kind, count(DISTINCT account_id) AS n FROM players
            UNION ALL SELECT 'matches', count(DISTINCT match_id) FROM players""",
        ),
        "seat_message_counts": _with(
            "chat players",
            f"""SELECT chat.match_id, count(*) AS message_rows, count(comment_text) AS messages
            {_AUTHORED} GROUP BY 1""",
        ),
        "toxic_in_ranges": _with(
            "chat",
            f"""SELECT timeline AS name, number_of_toxic_messages AS n_messages
            FROM ({_time_union(_OVERLAPPING)})""",
        ),
        # Sorting, limits, set operations
        "sort_by_count": _with(
            "chat",
            "SELECT unit, count(comment_text) AS n_messages FROM chat GROUP BY unit ORDER BY 2 DESC",
        ),
        "sort_by_hidden_count": _with(
            "chat",
            f"""SELECT unit, count(*) FILTER ({_TOXIC}) AS toxic FROM chat
            GROUP BY unit ORDER BY count(*) DESC""",
        ),
        "sort_by_group": _with(
            "chat",
            """SELECT CAST(len(predicted) AS INTEGER) AS number_of_labels,
            count(*) AS message_count FROM chat GROUP BY 1 ORDER BY 1""",
        ),
        "limit_rows": _with("matches", "SELECT * FROM matches ORDER BY match_id LIMIT 10"),
        "top_units": _with(
            "chat",
            """SELECT unit, count(comment_text) AS n_messages FROM chat
            GROUP BY unit ORDER BY 2 DESC, unit LIMIT 5""",
        ),
        "union_of_counts": _with("chat", _label_union("count(*) AS message_count")),
        "union_of_matches": _with(
            "chat matches", "SELECT match_id FROM chat UNION SELECT match_id FROM matches"
        ),
        "union_of_times": _with("chat", _time_union(_OVERLAPPING)),
        # Scalar functions
        "label_array_functions": _with(
            "training",
            f"""SELECT match_id, slot, time, {_LABELS_TEXT} AS removed, {_LABELS_TEXT} AS labels,
            CAST({" + ".join(f"{x}::INT" for x in LABELS)} AS INTEGER) AS n_labels,
            threat = '1' AS is_threat, {_VECTOR_TEXT} AS vector FROM training""",
        ),
        "cast_flags": _with(
            "training",
            f"""SELECT match_id, slot, time,
            {" + ".join(f"{x}::DOUBLE" for x in LABELS)} AS flags_set FROM training""",
        ),
        "round_and_divide": _with(
            "chat",
            f"""SELECT unit, count(*) AS n,
            round(count(*) FILTER ({_TOXIC}) / count(*) * 100) AS percent
            FROM chat GROUP BY unit""",
        ),
        "string_number_comparison": _with(
            "training", "SELECT count(*) AS clean FROM training WHERE toxic = 0"
        ),
    }

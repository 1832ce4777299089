"""Physical plans: what is read, pushed down and shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from tiltwatch.config import work_folder
from tiltwatch.operators.range_counts import range_counts
from tiltwatch.plans import documents as D
from tiltwatch.plans import elementary as E
from tiltwatch.plans import reports as R
from tiltwatch.plans.catalog import all_queries
from tiltwatch.sources import star

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def chat(spark):
    """Scored chat as a stored table."""
    path = work_folder(spark, "plans")
    star.chat_pred(spark, FOLDER).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^\n]*)>", text)]


def exchanges(text):
    return len(re.findall(r"[- ]Exchange ", text))


@pytest.mark.parametrize(
    "report,columns",
    [
        (R.toxic_vs_labelled, {"predicted"}),
        (R.toxic_split, {"predicted"}),
        (R.messages_per_label, {"predicted"}),
        (R.toxic_timeline, {"predicted", "time", "comment_text"}),
        (R.toxic_timeline_disjoint, {"predicted", "time", "comment_text"}),
    ],
)
def test_labelled_counts_scan_once_and_shuffle_once(chat, report, columns):
    text = plan(report(chat))
    assert scans(text) == [columns]
    assert exchanges(text) == 1
    assert "Union" not in text and "Expand" not in text


def test_match_share_has_no_expand(chat):
    text = plan(R.match_share_per_label(chat))
    assert scans(text) == [{"match_id", "predicted"}]
    assert exchanges(text) == 2 and "Expand" not in text


def test_union_form_scans_once_per_label(spark, chat):
    class Tables:
        pass

    tables = Tables()
    tables.chat = chat
    assert len(scans(plan(E.union_of_counts(tables)))) == 6


def test_join_reports_read_the_chat_in_one_fold(spark, chat):
    t = star.GameTables(spark, FOLDER)
    hot = R.HotKeys(*(df.persist() for df in R.hot_players(t.players)))
    fold = R.seat_fold(chat).persist()
    try:
        assert len(scans(plan(R.seat_fold(chat)))) == 1
        for report in R.join_reports(fold, t.players, t.matches, t.cluster_regions, hot).values():
            # Only the plan that fills the kept fold names the chat's text.
            assert "InMemoryRelation" in plan(report)
            outside = report._jdf.queryExecution().optimizedPlan().toString()
            outside = "\n".join(x for x in outside.splitlines() if x.lstrip(" :+-").startswith("Relation"))
            assert "comment_text" not in outside and "predicted" not in outside
    finally:
        for df in (fold, *hot):
            df.unpersist()


def test_range_counts_read_the_values_once(spark, chat):
    ranges = E.time_ranges(spark)
    text = plan(range_counts(chat.filter(F.col("comment_text").isNotNull()), "time", ranges))
    assert len(scans(text)) == 1


@pytest.mark.parametrize("name", ["region_activity", "region_activity_authored", "toxic_regions", "toxic_regions_authored", "messages_per_account", "toxic_players"])
def test_a_join_report_reads_chat_and_players_once(spark, chat, name):
    """Beside the one look for hot keys, of which these players have none."""
    game = star.GameTables(spark, FOLDER)
    path = work_folder(spark, "players")
    game.players.write.parquet(path)
    players = spark.read.parquet(path)
    more = () if name in ("messages_per_account", "toxic_players") else (game.matches, game.cluster_regions)
    read = scans(plan(getattr(R, name)(chat, players, *more, hot_share=0.5)))
    assert sum("account_id" in columns for columns in read) == 1
    assert sum(bool(columns & {"slot", "predicted", "comment_text"}) for columns in read) == 1
    assert not any(columns <= {"match_id", "player_slot"} for columns in read)


def test_filters_reach_the_scan(chat):
    text = plan(chat.filter(F.col("time").between(300, 600)).select("match_id"))
    assert "GreaterThanOrEqual(time,300)" in text and "LessThanOrEqual(time,600)" in text
    text = plan(R.toxic_timeline(chat))
    assert "IsNotNull(comment_text)" in text


def test_toxic_filter_lies_below_the_joins(spark, chat):
    t = star.GameTables(spark, FOLDER)
    text = plan(R.toxic_regions(chat, t.players, t.matches, t.cluster_regions))
    filtered = text.index("array_contains(predicted")
    assert filtered > text.index("HashAggregate(keys=[match_id")
    assert "TakeOrderedAndProject" in text and "CartesianProduct" not in text


def test_word_predictions_do_not_shuffle_text(spark):
    documents = star.read(spark, FOLDER, "documents")
    text = plan(D.word_predictions(documents, star.flags(spark, FOLDER)))
    for line in text.splitlines():
        if re.search(r"[- ]Exchange ", line):
            assert "text" not in line


@pytest.mark.parametrize("name", sorted(set(all_queries()) - {"stream_scoring", "split_csv_documents"}))
def test_no_python_worker_and_no_cross_join(spark, name):
    text = plan(all_queries()[name](spark, FOLDER))
    for operator in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "NestedLoop"):
        assert operator not in text


def test_preview_does_not_shuffle_text(spark):
    settings = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for key in settings:
            spark.conf.set(key, "-1")
        text = plan(all_queries()["training_preview_toxic"](spark, FOLDER))
    finally:
        for key in settings:
            spark.conf.unset(key)
    # Between the scan of the texts and the semi-join that picks them, nothing moves.
    lines = text.splitlines()
    scan = next(i for i, line in enumerate(lines) if re.search(r"ReadSchema: .*text:", line))
    above = next(line for line in reversed(lines[:scan]) if "Join" in line or "Exchange" in line)
    assert "BroadcastHashJoin" in above and "LeftSemi" in above
    assert "TakeOrderedAndProject" in text

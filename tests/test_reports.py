"""Reports on hand-made rows: edges, gaps and ties."""

import pytest
from pyspark.sql import functions as F

from tiltwatch.plans import reports as R

CHAT = "match_id bigint, slot int, time int, comment_text string, unit string, predicted array<string>"


@pytest.fixture(scope="module")
def game(spark):
    players = spark.createDataFrame(
        [(1, 100 + i, i) for i in range(10)] + [(2, 100, 0), (2, None, 1), (4, 300, 0)],
        "match_id bigint, account_id bigint, player_slot int",
    )
    matches = spark.createDataFrame(
        [(1, 11), (2, 12), (3, 11), (None, 11)], "match_id bigint, cluster int"
    )
    regions = spark.createDataFrame([(11, "north"), (12, "south")], "cluster int, region string")
    chat = spark.createDataFrame(
        [
            (1, 3, 10, "a", "u3", ["toxic"]),
            (2, 0, 20, "b", "u0", ["toxic", "insult"]),
            (2, 1, 30, None, "u1", ["toxic"]),
            (2, 9, 30, "nobody's seat", "u9", []),
            (3, 0, 30, "no players", "u0", ["toxic"]),
            (4, 0, 30, "no match row", "u0", ["toxic"]),
            (None, 0, 30, "no match id", "u0", ["toxic"]),
        ],
        CHAT,
    )
    return chat, players, matches, regions


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_fan_out_credits_every_player_of_the_match(game):
    assert rows(R.region_activity(*game)) == [("north", 10, 10), ("south", 1, 4)]


def test_authored_credits_only_the_writer(game):
    assert rows(R.region_activity_authored(*game)) == [("north", 1, 1), ("south", 1, 1)]


def test_fan_out_equals_the_plain_join(game):
    chat, players, matches, regions = game
    plain = (
        chat.join(players, "match_id")
        .join(matches, "match_id")
        .join(regions, "cluster")
        .groupBy("region")
        .agg(F.count_distinct("account_id"), F.count("comment_text"))
    )
    assert sorted(rows(plain)) == sorted(rows(R.region_activity(*game)))


def test_repeated_dimension_rows_multiply_like_the_plain_join(spark, game):
    chat, players, matches, regions = game
    doubled = (chat, players.union(players), matches.union(matches), regions.union(regions))
    assert rows(R.region_activity(*doubled)) == [("north", 10, 80), ("south", 1, 32)]
    assert rows(R.region_activity_authored(*doubled)) == [("north", 1, 8), ("south", 1, 8)]


def test_toxic_regions_and_players(game):
    chat, players, matches, regions = game
    assert rows(R.toxic_regions(*game)) == [("north", 10, 10), ("south", 1, 2)]
    assert rows(R.toxic_regions(*game, k=1)) == [("north", 10, 10)]
    assert rows(R.toxic_regions_authored(*game)) == [("north", 1, 1), ("south", 1, 1)]
    # Equal counts are ordered by account; the account NULL wrote no text.
    assert rows(R.toxic_players(chat, players)) == [(100, 1), (103, 1), (300, 1), (None, 0)]
    assert rows(R.toxic_players(chat, players, k=2)) == [(100, 1), (103, 1)]


def test_messages_per_account(game):
    chat, players, *_ = game
    assert rows(R.messages_per_account(chat, players)) == [(100, 1), (103, 1), (300, 1), (None, 0)]


def timed(spark, times):
    return spark.createDataFrame([(1, 0, t, "x", "u", ["toxic"]) for t in times], CHAT)


EDGES = [-10, 0, 300, 600, 1200, 2400, 2401, None]


def test_timeline_edges(spark):
    assert rows(R.toxic_timeline(timed(spark, EDGES))) == [
        ("Game_Lobby", 1),
        ("Less_Than_5_minutes", 2),
        ("5-10_minutes", 2),
        ("10-20_minutes", 2),
        ("20-30_minutes", 1),
        ("30-40_minutes", 1),
        ("40+minutes", 1),
    ]


def test_disjoint_timeline_counts_each_message_once(spark):
    result = rows(R.toxic_timeline_disjoint(timed(spark, EDGES)))
    assert sum(n for _, n in result) == 7
    assert dict(result)["40+minutes"] == 2


def test_timeline_takes_fractional_times(spark):
    chat = timed(spark, [0]).withColumn("time", F.lit(2400.5))
    assert dict(rows(R.toxic_timeline(chat)))["40+minutes"] == 1


def labelled(spark, sets):
    return spark.createDataFrame([(i, 0, 0, "x", "u", s) for i, s in enumerate(sets)], CHAT)


def test_empty_and_null_label_sets(spark):
    chat = labelled(spark, [[], None, ["insult"]])
    assert rows(R.toxic_vs_labelled(chat)) == [("Toxic", 0), ("Non-Toxic", 1)]
    assert rows(R.toxic_split(chat)) == [("Toxic", 0), ("Non-Toxic", 3)]
    assert rows(R.label_count_histogram(chat)) == [(1, 1)]


def test_labels_without_messages_keep_their_row(spark):
    chat = labelled(spark, [["toxic"], ["toxic", "obscene"]])
    assert rows(R.messages_per_label(chat)) == [
        ("Toxic", 2),
        ("Severe_toxic", 0),
        ("Obscene", 1),
        ("Threat", 0),
        ("Insult", 0),
        ("Identity_hate", 0),
    ]


def test_null_text_counts_as_message_but_not_in_the_timeline(spark):
    chat = labelled(spark, [["toxic"]]).withColumn("comment_text", F.lit(None).cast("string"))
    assert dict(rows(R.messages_per_label(chat)))["Toxic"] == 1
    assert dict(rows(R.toxic_timeline(chat)))["Less_Than_5_minutes"] == 0


def test_match_share(spark):
    chat = labelled(spark, [["toxic"], ["toxic"], ["threat"], []])
    chat = chat.unionByName(chat).unionByName(
        labelled(spark, [["toxic"]]).withColumn("match_id", F.lit(None).cast("bigint"))
    )
    shares = {r[0]: r[1:] for r in rows(R.match_share_per_label(chat))}
    assert shares["Toxic"] == (2, 50.0)
    assert shares["Threat"] == (1, 25.0)
    assert shares["Insult"] == (0, 0.0)


def test_reports_on_empty_chat(spark, game):
    _, players, matches, regions = game
    chat = spark.createDataFrame([], CHAT)
    assert rows(R.region_activity(chat, players, matches, regions)) == []
    assert rows(R.toxic_players(chat, players)) == []
    assert {r[1] for r in rows(R.messages_per_label(chat))} == {0}
    assert {r[1:] for r in rows(R.match_share_per_label(chat))} == {(0, None)}
    assert len(rows(R.toxic_timeline(chat))) == 7


def test_previews(spark):
    training = spark.createDataFrame(
        [(3, "c", "0"), (1, "a", "1"), (2, "b", "0")], "id int, comment_text string, toxic string"
    )
    assert [r[0] for r in rows(R.training_preview(training, "id", 2))] == [1, 2]
    assert rows(R.training_preview(training, "id", 1, 0)) == [(2, "b", "0")]
    assert rows(R.training_preview(training, "id", 1, 1)) == [(1, "a", "1")]

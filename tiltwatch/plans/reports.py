"""Reports on scored chat, each a function from DataFrames to a DataFrame.

``chat`` has ``match_id, slot, time, comment_text, predicted``; ``players`` has
``match_id, player_slot, account_id``; ``matches`` has ``match_id, cluster``;
``cluster_regions`` has ``cluster, region``.

Reports named ``*_authored``, ``*_split`` and ``*_disjoint`` are the corrected
readings of a report that counts by match, overlaps labels or overlaps times.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiltwatch.config import LABELS, TIMELINE, TIMELINE_DISJOINT, Span, display_name
from tiltwatch.functions.labels import has_label
from tiltwatch.functions.ranges import span_conditions
from tiltwatch.operators.counts import (
    grouped_counts,
    labelled_counts,
    labelled_distinct_counts,
    top_k,
)
from tiltwatch.operators.fanout import rows_per_key
from tiltwatch.operators.skew import HOT_SHARE, hot_keys, hot_levels, split_join


def _toxic(chat: DataFrame) -> DataFrame:
    return chat.filter(has_label("predicted", "toxic"))


def match_regions(matches: DataFrame, cluster_regions: DataFrame) -> DataFrame:
    """One row per match and region, with how often the two meet."""
    located = matches.join(cluster_regions, "cluster")
    return located.groupBy("match_id", "region").agg(F.count("*").alias("copies"))


def _region_totals(counted: DataFrame) -> DataFrame:
    """Distinct accounts and summed messages per region, busiest first."""
    accounts = counted.groupBy("region", "account_id").agg(
        F.sum("message_rows").alias("account_rows"), F.sum("messages").alias("messages")
    )
    seen = F.col("account_id").isNotNull()
    totals = accounts.groupBy("region").agg(
        F.count("account_id").alias("n_players"),
        F.sum("messages").alias("n_messages"),
        F.coalesce(F.sum(F.when(seen, F.col("account_rows"))), F.lit(0)).alias("busy"),
    )
    return totals.select("region", "n_players", "n_messages", "busy")


class HotKeys(NamedTuple):
    """The hot matches and seats among the players, found once for any number of reports."""

    matches: DataFrame
    seats: DataFrame


def hot_players(players: DataFrame, hot_share: float = HOT_SHARE) -> HotKeys:
    return HotKeys(*hot_levels(players, ["match_id", "player_slot"], hot_share))


def seat_fold(chat: DataFrame) -> DataFrame:
    """One row per match and seat with all that the six join reports need, from one scan.

    Messages of no seat stay, as the reports by match count them.
    """
    toxic = has_label("predicted", "toxic")
    return chat.groupBy("match_id", F.col("slot").alias("player_slot")).agg(
        F.count("*").alias("message_rows"),
        F.count("comment_text").alias("messages"),
        F.count_if(toxic).alias("toxic_rows"),
        F.count(F.when(toxic, F.col("comment_text"))).alias("toxic_messages"),
    )


def _toxic_seats(fold: DataFrame) -> DataFrame:
    return fold.filter("toxic_rows > 0").select(
        "match_id",
        "player_slot",
        F.col("toxic_rows").alias("message_rows"),
        F.col("toxic_messages").alias("messages"),
    )


def _matches_of(seats: DataFrame) -> DataFrame:
    return seats.groupBy("match_id").agg(
        F.sum("message_rows").alias("message_rows"), F.sum("messages").alias("messages")
    )


def _match_counts(chat: DataFrame) -> DataFrame:
    return rows_per_key(chat, ["match_id"], "comment_text", "chat").select(
        "match_id",
        F.col("chat_rows").alias("message_rows"),
        F.col("chat_comment_text").alias("messages"),
    )


def _seat_counts(chat: DataFrame) -> DataFrame:
    return rows_per_key(chat, ["match_id", "slot"], "comment_text", "chat").select(
        "match_id",
        F.col("slot").alias("player_slot"),
        F.col("chat_rows").alias("message_rows"),
        F.col("chat_comment_text").alias("messages"),
    )


def _times_copies(counted: DataFrame, *keys: str) -> DataFrame:
    return counted.select(
        *keys,
        (F.col("message_rows") * F.col("copies")).alias("message_rows"),
        (F.col("messages") * F.col("copies")).alias("messages"),
    )


def _match_level(
    counts: DataFrame,
    players: DataFrame,
    matches: DataFrame,
    cluster_regions: DataFrame,
    hot_matches: DataFrame,
) -> DataFrame:
    """Every player of a match credited with every message of that match.

    Equals joining the four tables on the match, but messages come as one row
    of ``counts`` per match, so no (message, player) pair is formed.
    """
    located = counts.join(match_regions(matches, cluster_regions), "match_id")
    per_match = _times_copies(located, "match_id", "region")
    seats = players.select("match_id", "account_id")
    return _region_totals(split_join(seats, per_match, ["match_id"], hot_matches))


def _authored(counts: DataFrame, players: DataFrame, hot_seats: DataFrame) -> DataFrame:
    joined = split_join(players, counts, ["match_id", "player_slot"], hot_seats)
    return joined.select("match_id", "account_id", "message_rows", "messages")


def authored_counts(chat: DataFrame, players: DataFrame, hot_share: float = HOT_SHARE) -> DataFrame:
    """Message counts per player row: ``match_id, account_id, message_rows, messages``."""
    hot = hot_keys(players, ["match_id", "player_slot"], hot_share)
    return _authored(_seat_counts(chat), players, hot)


def _authored_level(
    counts: DataFrame,
    players: DataFrame,
    matches: DataFrame,
    cluster_regions: DataFrame,
    hot: HotKeys,
) -> DataFrame:
    """Every message credited to the seat that wrote it, ``counts`` being per seat."""
    authored = _authored(counts, players, hot.seats)
    regions = match_regions(matches, cluster_regions)
    located = split_join(authored, regions, ["match_id"], hot.matches)
    return _region_totals(_times_copies(located, "region", "account_id"))


def _busiest_first(totals: DataFrame) -> DataFrame:
    return totals.orderBy(F.desc("busy"), "region").drop("busy")


def _busiest(totals: DataFrame, k: int) -> DataFrame:
    return top_k(totals, "busy", k, ["region"]).drop("busy")


def region_activity(
    chat: DataFrame,
    players: DataFrame,
    matches: DataFrame,
    cluster_regions: DataFrame,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Players and messages per region, joined by match."""
    hot = hot_keys(players, ["match_id"], hot_share)
    return _busiest_first(_match_level(_match_counts(chat), players, matches, cluster_regions, hot))


def region_activity_authored(
    chat: DataFrame,
    players: DataFrame,
    matches: DataFrame,
    cluster_regions: DataFrame,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Players who wrote, and their messages, per region."""
    hot = hot_players(players, hot_share)
    return _busiest_first(_authored_level(_seat_counts(chat), players, matches, cluster_regions, hot))


def toxic_regions(
    chat: DataFrame,
    players: DataFrame,
    matches: DataFrame,
    cluster_regions: DataFrame,
    k: int = 5,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """The ``k`` regions with most toxic messages, joined by match."""
    hot = hot_keys(players, ["match_id"], hot_share)
    counts = _match_counts(_toxic(chat))
    return _busiest(_match_level(counts, players, matches, cluster_regions, hot), k)


def toxic_regions_authored(
    chat: DataFrame,
    players: DataFrame,
    matches: DataFrame,
    cluster_regions: DataFrame,
    k: int = 5,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """The ``k`` regions with most toxic messages, by the seat that wrote them."""
    hot = hot_players(players, hot_share)
    counts = _seat_counts(_toxic(chat))
    return _busiest(_authored_level(counts, players, matches, cluster_regions, hot), k)


def _account_totals(authored: DataFrame) -> DataFrame:
    return authored.groupBy("account_id").agg(F.sum("messages").alias("n_messages"))


def _most_first(authored: DataFrame) -> DataFrame:
    return _account_totals(authored).orderBy(F.desc("n_messages"), "account_id")


def messages_per_account(
    chat: DataFrame, players: DataFrame, hot_share: float = HOT_SHARE
) -> DataFrame:
    """Messages written per account, most first."""
    return _most_first(authored_counts(chat, players, hot_share))


def toxic_players(
    chat: DataFrame, players: DataFrame, k: int = 10, hot_share: float = HOT_SHARE
) -> DataFrame:
    """The ``k`` accounts with most toxic messages."""
    authored = authored_counts(_toxic(chat), players, hot_share)
    return top_k(_account_totals(authored), "n_messages", k, ["account_id"])


def join_reports(
    fold: DataFrame,
    players: DataFrame,
    matches: DataFrame,
    cluster_regions: DataFrame,
    hot: HotKeys,
    regions: int = 5,
    accounts: int = 10,
) -> dict[str, DataFrame]:
    """The six join reports from one :func:`seat_fold` and one search for hot keys."""
    game = (players, matches, cluster_regions)
    toxic = _toxic_seats(fold)
    toxic_totals = _account_totals(_authored(toxic, players, hot.seats))
    return {
        "region_activity": _busiest_first(_match_level(_matches_of(fold), *game, hot.matches)),
        "region_activity_authored": _busiest_first(_authored_level(fold, *game, hot)),
        "messages_per_account": _most_first(_authored(fold, players, hot.seats)),
        "toxic_regions_top5": _busiest(_match_level(_matches_of(toxic), *game, hot.matches), regions),
        "toxic_regions_authored": _busiest(_authored_level(toxic, *game, hot), regions),
        "toxic_players_top10": top_k(toxic_totals, "n_messages", accounts, ["account_id"]),
    }


def _labelled() -> dict[str, Column]:
    return {
        "Toxic": has_label("predicted", "toxic"),
        "Non-Toxic": F.size("predicted") > 0,
    }


def _split() -> dict[str, Column]:
    toxic = F.coalesce(has_label("predicted", "toxic"), F.lit(False))
    return {"Toxic": toxic, "Non-Toxic": ~toxic}


def _per_label(labels: Sequence[str] = LABELS) -> dict[str, Column]:
    return {display_name(label): has_label("predicted", label) for label in labels}


def toxic_vs_labelled(chat: DataFrame) -> DataFrame:
    """Messages labelled toxic against messages with any label.

    The second row carries the name ``Non-Toxic`` although it includes the
    toxic messages; ``toxic_split`` is the real complement.
    """
    return labelled_counts(chat, _labelled(), "label_type", "message_count")


def toxic_split(chat: DataFrame) -> DataFrame:
    """Messages labelled toxic against all others."""
    return labelled_counts(chat, _split(), "label_type", "message_count")


def messages_per_label(chat: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Messages per label; a label without messages shows 0."""
    return labelled_counts(chat, _per_label(labels), "label_type", "message_count")


def label_count_histogram(chat: DataFrame) -> DataFrame:
    """Labelled messages by how many labels they carry."""
    sizes = chat.select(F.size("predicted").alias("number_of_labels"))
    return (
        sizes.filter(F.col("number_of_labels") > 0)
        .groupBy("number_of_labels")
        .agg(F.count("*").alias("message_count"))
        .orderBy("number_of_labels")
    )


def match_share_per_label(chat: DataFrame, labels: Sequence[str] = LABELS) -> DataFrame:
    """Matches with a message of each label, and their share of matches with chat."""
    return labelled_distinct_counts(
        chat,
        "match_id",
        _per_label(labels),
        "label_type",
        "match_count",
        "percent_of_total_matches",
    )


def toxic_timeline(chat: DataFrame, spans: Sequence[Span] = TIMELINE) -> DataFrame:
    """Toxic messages with text per span of match time."""
    written = _toxic(chat).filter(F.col("comment_text").isNotNull())
    return labelled_counts(
        written, span_conditions("time", spans), "timeline", "number_of_toxic_messages"
    )


def toxic_timeline_disjoint(chat: DataFrame) -> DataFrame:
    """As ``toxic_timeline``, each message in at most one span."""
    return toxic_timeline(chat, TIMELINE_DISJOINT)


def message_counts(chat: DataFrame) -> DataFrame:
    """The five reports that only count messages, as ``report, name, n`` from one scan."""
    written = has_label("predicted", "toxic") & F.col("comment_text").isNotNull()

    def timeline(spans: Sequence[Span]) -> dict[str, Column]:
        return {name: written & inside for name, inside in span_conditions("time", spans).items()}

    groups = {
        "toxic_vs_labelled": _labelled(),
        "toxic_split": _split(),
        "messages_per_label": _per_label(),
        "toxic_timeline": timeline(TIMELINE),
        "toxic_timeline_disjoint": timeline(TIMELINE_DISJOINT),
    }
    return grouped_counts(chat, groups, "report", "name", "n")


def training_preview(training: DataFrame, key: str, rows: int, toxic: int | None = None) -> DataFrame:
    """The first ``rows`` training comments by ``key``, all or of one toxicity."""
    chosen = training
    if toxic is not None:
        chosen = training.filter(F.col("toxic").cast("int") == toxic)
    return chosen.orderBy(key).limit(rows)


def predicted_preview(chat: DataFrame, rows: int = 10) -> DataFrame:
    """A few scored messages in a definite order."""
    shown = ["match_id", "comment_text", "slot", "time", "unit", "predicted"]
    return chat.select(*shown).orderBy(*shown).limit(rows)

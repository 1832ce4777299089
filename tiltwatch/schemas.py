"""Typed schemas of the CSV files."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tiltwatch.config import LABELS


def _fields(**types) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


COMMENTS = StructType(
    [StructField("id", StringType()), StructField("comment_text", StringType())]
    + [StructField(label, IntegerType()) for label in LABELS]
)

CHAT = _fields(
    match_id=LongType(), key=StringType(), slot=IntegerType(), time=IntegerType(), unit=StringType()
)

PLAYERS = _fields(match_id=LongType(), account_id=LongType(), player_slot=IntegerType())

MATCH = _fields(match_id=LongType(), cluster=IntegerType())

CLUSTER_REGIONS = _fields(cluster=IntegerType(), region=StringType())

# Column types by name. A file's own header decides which columns it has and in
# which order; columns not listed here stay text.
TYPES = {
    "train": COMMENTS,
    "test": COMMENTS,
    "match": MATCH,
    "match_outcomes": StructType([]),
    "player_ratings": StructType([]),
    "players": PLAYERS,
    "chat": CHAT,
    "cluster_regions": CLUSTER_REGIONS,
}

# The table name of each file.
TABLES = {
    "train": "toxicity_training",
    "test": "toxicity_test",
    "match": "toxicity_match",
    "match_outcomes": "toxicity_match_outcomes",
    "player_ratings": "toxicity_player_ratings",
    "players": "toxicity_players",
    "chat": "toxicity_chat",
    "cluster_regions": "toxicity_cluster_regions",
}

# Files with free text, whose quoted fields may hold line breaks.
MULTI_LINE = frozenset({"train", "test", "chat"})

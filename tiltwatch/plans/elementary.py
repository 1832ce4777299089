"""Single operators on the chat tables, one small query each.

Each shows one projection, predicate, join, aggregate, sort or set operation
that the reports are made of, over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiltwatch.config import LABELS, TIMELINE, display_name
from tiltwatch.functions.labels import flag_is_set, has_label, label_set, label_vector
from tiltwatch.functions.ranges import in_span
from tiltwatch.operators.counts import labelled_counts, top_k
from tiltwatch.operators.fanout import pair_counts
from tiltwatch.operators.skew import hot_keys, split_join
from tiltwatch.plans.reports import authored_counts
from tiltwatch.sources.star import GameTables


def _joined(array: str | Column) -> Column:
    return F.array_join(array, ",")


def _numbers(array: str | Column) -> Column:
    """A 0/1 vector as text such as ``1,0,0``."""
    return _joined(F.transform(array, lambda x: x.cast("int").cast("string")))


# Projections


def select_all(t: GameTables) -> DataFrame:
    return t.matches.select("*")


def select_expressions(t: GameTables) -> DataFrame:
    return t.chat.select(
        "match_id", "slot", (F.col("time") + 300).alias("since_lobby"), F.upper("unit").alias("who")
    )


def rename_columns(training: DataFrame) -> DataFrame:
    return training.withColumnsRenamed({label: f"{label}_true" for label in LABELS})


def add_columns(t: GameTables) -> DataFrame:
    added = t.chat.withColumns(
        {
            "has_text": F.col("comment_text").isNotNull(),
            "number_of_labels": F.size("predicted"),
        }
    )
    return added.select("match_id", "slot", "time", "has_text", "number_of_labels")


def drop_columns(t: GameTables) -> DataFrame:
    # "document" and "token" are not there; dropping a missing column is no error.
    return t.chat.drop("predicted", "document", "token")


def array_constructor(training: DataFrame) -> DataFrame:
    flags = F.array(*[F.col(label) for label in LABELS])
    return training.select("match_id", "slot", "time", _joined(flags).alias("flags"))


def nested_field(t: GameTables) -> DataFrame:
    """The field of every struct in an array, as an array."""
    classes = F.transform(
        "predicted", lambda x: F.struct(x.alias("result"), F.length(x).alias("confidence"))
    )
    nested = t.chat.select("match_id", "slot", "time", classes.alias("class"))
    return nested.select("match_id", "slot", "time", _joined("class.result").alias("results"))


def constant_column(t: GameTables) -> DataFrame:
    toxic = t.chat.filter(has_label("predicted", "toxic"))
    return toxic.agg(F.count("*").alias("message_count")).select(
        F.lit("Toxic").alias("label_type"), "message_count"
    )


def inline_view(t: GameTables) -> DataFrame:
    inner = constant_column(t)
    return inner.select(
        F.col("label_type").alias("kind"), (F.col("message_count") * 2).alias("twice")
    )


def scalar_subquery(t: GameTables) -> DataFrame:
    """Each region's share of all clusters, the total being a subquery."""
    total = t.cluster_regions.agg(F.count_distinct("cluster").alias("n")).scalar()
    per_region = t.cluster_regions.groupBy("region").agg(
        F.count_distinct("cluster").alias("clusters")
    )
    share = F.round(F.col("clusters") / total * 100)
    return per_region.select("region", "clusters", share.alias("percent"))


# Predicates


def string_flag_equality(training: DataFrame) -> DataFrame:
    rows = training.filter(flag_is_set("toxic"))
    return rows.select("match_id", "slot", "time", "comment_text")


def case_on_flag(training: DataFrame) -> DataFrame:
    named = F.when(F.col("toxic") == "1", F.lit("toxic")).otherwise(F.lit("0"))
    return training.select("match_id", "slot", "time", named.alias("toxic"))


def array_membership(t: GameTables) -> DataFrame:
    rows = t.chat.filter(has_label("predicted", "insult"))
    return rows.select("match_id", "slot", "time", "comment_text")


def array_empty(t: GameTables) -> DataFrame:
    conditions = {"empty": F.size("predicted") == 0, "filled": F.size("predicted") > 0}
    return labelled_counts(t.chat, conditions, "kind", "n")


def time_comparison(t: GameTables) -> DataFrame:
    late = t.chat.filter(F.col("time") > 2400)
    return late.select("match_id", "slot", "time", "comment_text")


def time_between(t: GameTables) -> DataFrame:
    inside = t.chat.filter(F.col("time").between(300, 600))
    return inside.select("match_id", "slot", "time", "comment_text")


def conjunction(t: GameTables) -> DataFrame:
    rows = t.chat.filter(has_label("predicted", "toxic") & (F.col("time") < 0))
    return rows.select("match_id", "slot", "time", "comment_text")


def filter_after_limit(labelled: DataFrame, key: str) -> DataFrame:
    """The first row, shown only if it has no label."""
    first = labelled.orderBy(key).limit(1)
    return first.filter(F.size("labels") == 0).select(key, F.size("labels").alias("n_labels"))


# Joins


def match_join_pairs(t: GameTables) -> DataFrame:
    """Per match, the rows a chat-to-players join on the match alone would have."""
    return pair_counts(t.chat, t.players, "match_id")


def players_with_match(t: GameTables) -> DataFrame:
    per_match = t.matches.groupBy("match_id", "cluster").agg(F.count("*").alias("copies"))
    joined = split_join(t.players, per_match, ["match_id"], hot_keys(t.players, ["match_id"]))
    return joined.select("match_id", "player_slot", "account_id", "cluster", "copies")


def match_with_region(t: GameTables) -> DataFrame:
    return t.matches.join(t.cluster_regions, "cluster").select("match_id", "cluster", "region")


def authored_messages(t: GameTables) -> DataFrame:
    """Each message with the account in its seat, joined on two differently named keys."""
    seats = t.players.withColumnRenamed("player_slot", "slot")
    keys = ["match_id", "slot"]
    joined = split_join(t.chat, seats, keys, hot_keys(t.chat, keys))
    return joined.select("match_id", "slot", "time", "comment_text", "account_id")


def four_table_join(t: GameTables) -> DataFrame:
    """Joined rows per match and region over chat, players, matches and regions."""
    pairs = pair_counts(t.chat, t.players, "match_id")
    located = t.matches.join(t.cluster_regions, "cluster")
    return (
        located.groupBy("match_id", "region")
        .agg(F.count("*").alias("copies"))
        .join(pairs, "match_id")
        .select("match_id", "region", (F.col("pairs") * F.col("copies")).alias("joined_rows"))
    )


# Aggregates


def group_by_column(t: GameTables) -> DataFrame:
    return t.players.groupBy("account_id").agg(F.count("*").alias("seats"))


def group_by_expression(t: GameTables) -> DataFrame:
    return t.chat.groupBy(F.size("predicted").alias("number_of_labels")).agg(
        F.count("*").alias("message_count")
    )


def global_aggregate(t: GameTables) -> DataFrame:
    """One row even where nothing matches."""
    none = t.chat.filter(has_label("predicted", "no such label"))
    return none.agg(F.count("*").alias("message_count"))


def count_variants(t: GameTables) -> DataFrame:
    return t.chat.agg(
        F.count("*").alias("messages"),
        F.count("comment_text").alias("with_text"),
        F.count_if(has_label("predicted", "toxic")).alias("toxic"),
    )


def count_distinct(t: GameTables) -> DataFrame:
    """Two distinct counts, each on its own: counted together, Spark would copy every row."""
    counts = [
        t.players.agg(F.lit(name).alias("kind"), F.count_distinct(column).alias("n"))
        for name, column in (("accounts", "account_id"), ("matches", "match_id"))
    ]
    return counts[0].union(counts[1])


def union_of_counts(t: GameTables) -> DataFrame:
    """The union form of the label counts: one scan and one shuffle per label."""
    branches = [
        t.chat.filter(has_label("predicted", label)).agg(
            F.lit(display_name(label)).alias("label_type"), F.count("*").alias("message_count")
        )
        for label in LABELS
    ]
    union = branches[0]
    for branch in branches[1:]:
        union = union.union(branch)
    return union.distinct()


def union_of_times(t: GameTables) -> DataFrame:
    """The union form of the timeline."""
    toxic = t.chat.filter(has_label("predicted", "toxic"))
    branches = [
        toxic.filter(in_span("time", span)).agg(
            F.lit(span.name).alias("timeline"),
            F.count("comment_text").alias("number_of_toxic_messages"),
        )
        for span in TIMELINE
    ]
    union = branches[0]
    for branch in branches[1:]:
        union = union.union(branch)
    return union.distinct()


def union_of_matches(t: GameTables) -> DataFrame:
    """Matches known from the chat or the match table, each once."""
    return t.chat.select("match_id").union(t.matches.select("match_id")).distinct()


def time_ranges(spark: SparkSession) -> DataFrame:
    """The timeline for whole seconds as a table of closed ranges."""
    rows = []
    for span in TIMELINE:
        low = span.at_least if span.above is None else span.above + 1
        high = span.at_most if span.below is None else span.below - 1
        rows.append((span.name, low, high))
    return spark.createDataFrame(rows, "name string, low bigint, high bigint")


# Sorting and limits


def sort_by_count(t: GameTables) -> DataFrame:
    counted = t.chat.groupBy("unit").agg(F.count("comment_text").alias("n_messages"))
    return counted.orderBy(F.desc("n_messages"), "unit")


def sort_by_hidden_count(t: GameTables) -> DataFrame:
    """Sorted by an aggregate that is not shown."""
    counted = t.chat.groupBy("unit").agg(
        F.count_if(has_label("predicted", "toxic")).alias("toxic"), F.count("*").alias("hidden")
    )
    return counted.orderBy(F.desc("hidden"), "unit").select("unit", "toxic")


def sort_by_group(t: GameTables) -> DataFrame:
    return group_by_expression(t).orderBy("number_of_labels")


def limit_rows(t: GameTables) -> DataFrame:
    return t.matches.orderBy("match_id").limit(10)


def top_units(t: GameTables) -> DataFrame:
    counted = t.chat.groupBy("unit").agg(F.count("comment_text").alias("n_messages"))
    return top_k(counted, "n_messages", 5, ["unit"])


def seat_message_counts(t: GameTables) -> DataFrame:
    """Messages and texts per player row."""
    return authored_counts(t.chat, t.players).groupBy("match_id").agg(
        F.sum("message_rows").alias("message_rows"), F.sum("messages").alias("messages")
    )


# Scalar functions


def label_array_functions(training: DataFrame) -> DataFrame:
    """Flags to a label set two ways, its size, membership and vector."""
    named = F.array(
        *[F.when(F.col(x) == "1", F.lit(x)).otherwise(F.lit("0")) for x in LABELS]
    )
    labels = label_set({x: flag_is_set(x) for x in LABELS})
    return training.select(
        "match_id",
        "slot",
        "time",
        _joined(F.array_remove(named, "0").cast("array<string>")).alias("removed"),
        _joined(labels).alias("labels"),
        F.size(labels).alias("n_labels"),
        F.array_contains(labels, "threat").alias("is_threat"),
        _numbers(label_vector(labels)).alias("vector"),
    )


def cast_flags(training: DataFrame) -> DataFrame:
    """Text flags as doubles, summed."""
    total = sum((F.col(x).cast("double") for x in LABELS[1:]), F.col("toxic").cast("double"))
    return training.select("match_id", "slot", "time", total.alias("flags_set"))


def round_and_divide(t: GameTables) -> DataFrame:
    per_unit = t.chat.groupBy("unit").agg(
        F.round(F.count("*")).alias("n"),
        F.count_if(has_label("predicted", "toxic")).alias("toxic"),
    )
    return per_unit.select(
        "unit", "n", F.round(F.col("toxic") / F.col("n") * 100).alias("percent")
    )


def string_number_comparison(training: DataFrame) -> DataFrame:
    """Text compared with a number: the text is cast, and bad text fails the job."""
    clean = training.filter(F.col("toxic") == 0)
    return clean.agg(F.count("*").alias("clean"))

"""Gold tables kept up to date: what each batch adds is folded once, and the folds are added up."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiltwatch.config import LABELS, display_name
from tiltwatch.functions.labels import has_label
from tiltwatch.operators.counts import labelled_distinct_counts
from tiltwatch.plans import reports as R
from tiltwatch.sources.layout import folder_bytes
from tiltwatch.sources.parts import Part, PartFolder, tail
from tiltwatch.streaming.batches import BatchTarget

_SUMS = ("message_rows", "messages", "toxic_rows", "toxic_messages")
_FLAGS = {display_name(label): f"flag_{i}" for i, label in enumerate(LABELS)}


def _match_flags(chat: DataFrame) -> DataFrame:
    flags = [
        F.coalesce(F.bool_or(has_label("predicted", label)), F.lit(False)).alias(flag)
        for label, flag in zip(LABELS, _FLAGS.values())
    ]
    return chat.filter("match_id IS NOT NULL").groupBy("match_id").agg(*flags)


#: What is kept of a batch, and how two such folds make one.
_FOLDS = {
    "counts": (
        R.message_counts,
        lambda rows: rows.groupBy("report", "name").agg(F.sum("n").alias("n")),
    ),
    "sizes": (
        R.label_count_histogram,
        lambda rows: rows.groupBy("number_of_labels").agg(F.sum("message_count").alias("message_count")),
    ),
    "seats": (
        R.seat_fold,
        lambda rows: rows.groupBy("match_id", "player_slot").agg(*(F.sum(c).alias(c) for c in _SUMS)),
    ),
    "matches": (
        _match_flags,
        lambda rows: rows.groupBy("match_id").agg(*(F.bool_or(c).alias(c) for c in _FLAGS.values())),
    ),
}


def pending(source: list[Part], folded: list[Part]) -> list[tuple[Part, list[Part]]]:
    """Ranges to fold, each with the source parts that make it up.

    Source parts whose batches are all folded need nothing, however they were
    merged since. One that holds new batches beside folded ones is folded whole, and with it all that
    its range and the folds in it touch, so that the new fold covers the old ones exactly.
    """

    def done(part: Part) -> bool:
        at = part.first
        for f in folded:  # ascending and apart
            if f.first <= at <= f.last:
                at = f.last + 1
        return at > part.last

    ranges: list[Part] = []
    for part in source:
        if done(part):
            continue
        grown, now = None, part
        while grown != now:
            grown = now
            for other in (*source, *folded, *ranges):
                if other.first <= now.last and now.first <= other.last:
                    now = Part(min(now.first, other.first), max(now.last, other.last))
        ranges = [r for r in ranges if not (now.first <= r.first and r.last <= now.last)] + [now]
    return [(r, [p for p in source if r.first <= p.first and p.last <= r.last]) for r in ranges]


@dataclass(frozen=True)
class GoldStates:
    """Folds of scored chat, by range of batches, in one folder per kind."""

    folder: str

    def of(self, kind: str) -> PartFolder:
        return PartFolder(f"{self.folder}/{kind}")

    def update(self, spark: SparkSession, chat: BatchTarget) -> list[str]:
        """Fold what is new among the committed batches; returns the folders of chat that were read.

        Each kind of fold keeps track by itself, so a run that dies midway is made good by the next.
        """
        read: list[str] = []
        settled = chat.settled(spark)
        for kind, (fold, _) in _FOLDS.items():
            states = self.of(kind)
            for part, parts in pending(settled, states.live(spark)):
                states.write(fold(chat.read(spark, parts)), part)
                read += [chat.place(p) for p in parts if chat.place(p) not in read]
        return read

    def merge(self, spark: SparkSession, whole: bool = False) -> None:
        """Add up the newest folds of each kind into one, so that their number stays small."""
        for kind, (_, add) in _FOLDS.items():
            states = self.of(kind)
            live = states.live(spark)
            parts = tail(live, [folder_bytes(spark, states.place(p)) for p in live], whole)
            if parts:
                states.write(add(states.read(spark, parts)), Part(parts[0].first, parts[-1].last))

    def clean(self, spark: SparkSession) -> None:
        for kind in _FOLDS:
            self.of(kind).clean(spark)

    def total(self, spark: SparkSession, kind: str) -> DataFrame:
        """The fold of all batches."""
        return _FOLDS[kind][1](self.of(kind).read(spark))

    def match_share_per_label(self, spark: SparkSession) -> DataFrame:
        flags = {name: F.col(flag) for name, flag in _FLAGS.items()}
        return labelled_distinct_counts(
            self.of("matches").read(spark), "match_id", flags, "label_type", "match_count", "percent_of_total_matches"
        )

    def label_count_histogram(self, spark: SparkSession) -> DataFrame:
        return self.total(spark, "sizes").orderBy("number_of_labels")

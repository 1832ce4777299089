"""Names, label set and thresholds shared by every job."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

# The label set, in its positional order.
LABELS = ("toxic", "severe_toxic", "obscene", "threat", "insult", "identity_hate")


@dataclass(frozen=True)
class Span:
    """A named stretch of a number line; an end left out is open."""

    name: str
    at_least: float | None = None
    at_most: float | None = None
    above: float | None = None
    below: float | None = None


# Match-time spans in seconds. They overlap on purpose: the lobby
# is also "less than 5 minutes", and a message at an edge such as 600 counts in
# both neighbours.
TIMELINE = (
    Span("Game_Lobby", below=0),
    Span("Less_Than_5_minutes", below=300),
    Span("5-10_minutes", at_least=300, at_most=600),
    Span("10-20_minutes", at_least=600, at_most=1200),
    Span("20-30_minutes", at_least=1200, at_most=1800),
    Span("30-40_minutes", at_least=1800, at_most=2400),
    Span("40+minutes", above=2400),
)

# The same names, each moment in one span only.
TIMELINE_DISJOINT = (
    Span("Game_Lobby", below=0),
    Span("Less_Than_5_minutes", at_least=0, below=300),
    Span("5-10_minutes", at_least=300, below=600),
    Span("10-20_minutes", at_least=600, below=1200),
    Span("20-30_minutes", at_least=1200, below=1800),
    Span("30-40_minutes", at_least=1800, below=2400),
    Span("40+minutes", at_least=2400),
)


def display_name(label: str) -> str:
    """``severe_toxic`` -> ``Severe_toxic``, the spelling used in reports."""
    return label[:1].upper() + label[1:]


def sql_name(text: str) -> str:
    """A user or project name made safe for use inside a database name."""
    return re.sub(r"\W", "_", text)


@dataclass(frozen=True)
class Settings:
    """One place for the names that the jobs share."""

    user: str
    location: str | None = None
    prefix: str = "gaming"
    model_name: str = "toxicity_multilabel"

    @property
    def database(self) -> str:
        return f"{self.prefix}_{sql_name(self.user)}"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for files a job has to write.

    It lies in the shared folder that the session names in
    ``spark.checkpoint.dir``, else in the warehouse, which all executors share
    as well. It is deleted when the driver ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{root.rstrip('/')}/tiltwatch/{purpose}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder

"""Folders of Parquet parts named by the range of batches that they hold."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True, order=True)
class Part:
    """The rows of batches ``first`` to ``last`` in one folder."""

    first: int
    last: int

    @property
    def name(self) -> str:
        return f"{self.first:012d}-{self.last:012d}"


@dataclass(frozen=True)
class PartFolder:
    """A folder of parts. A part counts once its success marker, written last, is there.

    A part whose range includes that of another holds the same rows or what stands for them: from the
    moment of its marker on, readers take it in place of the parts it covers.
    So neither writing nor merging needs a lock, a log or a rename, and a run that
    dies leaves nothing to repair.
    """

    folder: str

    def _path(self, spark: SparkSession, *names: str):
        return spark._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *names)))

    def _fs(self, spark: SparkSession):
        return self._path(spark).getFileSystem(spark._jsc.hadoopConfiguration())

    def complete(self, spark: SparkSession) -> list[Part]:
        """All parts with their marker, covered ones included."""
        fs = self._fs(spark)
        if not fs.exists(self._path(spark)):
            return []
        found = fs.globStatus(self._path(spark, "*-*", "_SUCCESS"))
        names = [status.getPath().getParent().getName() for status in found]
        return sorted(Part(*map(int, name.split("-"))) for name in names)

    def live(self, spark: SparkSession) -> list[Part]:
        """The parts to read: those that no other covers, which hold each batch once."""
        kept: list[Part] = []
        for part in sorted(self.complete(spark), key=lambda p: (p.first, -p.last)):
            if not kept or part.last > kept[-1].last:
                kept.append(part)
        return kept

    def place(self, part: Part) -> str:
        return f"{self.folder}/{part.name}"

    def read(self, spark: SparkSession, parts: list[Part] | None = None) -> DataFrame:
        """The rows of these parts, of all live ones by default; columns that came later are NULL in older rows."""
        parts = self.live(spark) if parts is None else parts
        if not parts:
            raise ValueError(f"{self.folder} holds no batch yet")
        return spark.read.option("mergeSchema", "true").parquet(*map(self.place, parts))

    def write(self, rows: DataFrame, part: Part) -> None:
        """``rows`` as ``part``, in place of what that part held."""
        rows.write.mode("overwrite").parquet(self.place(part))

    def clean(self, spark: SparkSession) -> list[Part]:
        """Delete the parts that others cover, once no reader that began before is left."""
        live = set(self.live(spark))
        gone = [p for p in self.complete(spark) if p not in live]
        for part in gone:
            self._fs(spark).delete(self._path(spark, part.name), True)
        return gone


def tail(parts: list[Part], sizes: list[int], whole: bool = False) -> list[Part]:
    """The newest parts to merge: back from the last, while one holds no more than twice what the newer ones do.

    So a row is merged a number of times that grows with the logarithm of the
    table only. ``whole`` takes all parts. Fewer than two are none.
    """
    taken: list[Part] = []
    held = 0
    for part, size in zip(reversed(parts), reversed(sizes)):
        if taken and size > 2 * held and not whole:
            break
        taken.insert(0, part)
        held += size
    return taken if len(taken) > 1 else []

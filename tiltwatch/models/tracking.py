"""Run log as a table, model registry as a folder of small records that any number of drivers may add to."""

from __future__ import annotations

import datetime as dt
import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiltwatch.sources.tables import append_evolving

RUNS = (
    "run_id string, experiment string, started timestamp, ended timestamp, "
    "params map<string,string>, metrics map<string,double>, status string"
)
#: The stage of versions that others have taken the place of.
ARCHIVED = "Archived"
REGISTRY = (
    "name string, version int, stage string, path string, run_id string, registered timestamp"
)


def _append(spark: SparkSession, table: str, schema: str, row: tuple) -> None:
    append_evolving(spark, spark.createDataFrame([row], schema), table)


class Run:
    """Collects the parameters and metrics of one run, logged when the block ends.

    A run whose block raises is logged as ``failed`` with what it had so far;
    the error goes on.
    """

    def __init__(self, spark: SparkSession, table: str, experiment: str):
        self.spark = spark
        self.table = table
        self.experiment = experiment
        self.run_id = uuid.uuid4().hex
        self.params: dict[str, str] = {}
        self.metrics: dict[str, float] = {}

    def __enter__(self) -> "Run":
        self.started = dt.datetime.now()
        return self

    def log_param(self, name: str, value) -> None:
        self.params[name] = str(value)

    def log_metric(self, name: str, value: float) -> None:
        self.metrics[name] = float(value)

    def __exit__(self, kind, value, trace) -> None:
        row = (
            self.run_id,
            self.experiment,
            self.started,
            dt.datetime.now(),
            self.params,
            self.metrics,
            "finished" if kind is None else "failed",
        )
        _append(self.spark, self.table, RUNS, row)


def _path(spark: SparkSession, *names: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(names))


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def _claim(spark: SparkSession, folder: str) -> int:
    """The next number in ``folder`` that nobody else has, taken by creating its marker.

    Creating a file that must not exist is atomic on HDFS, on local disks and
    on the object stores that can be written on condition; of two drivers one fails and tries the next number.
    """
    fs = _fs(spark, _path(spark, folder))
    fs.mkdirs(_path(spark, folder))
    taken = [s.getPath().getName() for s in fs.listStatus(_path(spark, folder))]
    number = max((int(n.split(".")[0]) for n in taken if n[0].isdigit()), default=0)
    while True:
        number += 1
        marker = _path(spark, folder, f"{number:09d}.claim")
        if fs.getScheme() == "file":  # Hadoop's local file system looks first and creates then
            if spark._jvm.java.io.File(marker.toUri().getPath()).createNewFile():
                return number
            continue
        try:
            fs.create(marker, False).close()
            return number
        except Py4JJavaError:
            if not fs.exists(marker):
                raise


def _record(spark: SparkSession, folder: str, number: int, facts: dict) -> None:
    """Put what the claimed number stands for in place with one rename, so that readers see all of it or nothing."""
    draft, final = (_path(spark, folder, name) for name in (f"_{number:09d}.draft", f"{number:09d}.json"))
    fs = _fs(spark, final)
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(facts).encode()))
    out.close()
    if not fs.rename(draft, final):
        raise OSError(f"{final} could not be put in place")


def _records(spark: SparkSession, folder: str) -> list[tuple[int, dict]]:
    path = _path(spark, folder, "*.json")
    found = _fs(spark, path).globStatus(path) or []
    names = sorted(s.getPath().getName() for s in found)
    if not names:
        return []
    read = spark.read.option("wholetext", "true").text([f"{folder}/{n}" for n in names])
    rows = read.select(F.col("_metadata.file_name").alias("name"), "value").collect()
    return sorted((int(r["name"].split(".")[0]), json.loads(r["value"])) for r in rows)


def _names(spark: SparkSession, registry: str) -> list[str]:
    fs = _fs(spark, _path(spark, registry))
    if not fs.exists(_path(spark, registry)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(_path(spark, registry)) if s.isDirectory())


def _versions(spark: SparkSession, registry: str, name: str) -> list[dict]:
    """All versions of a model, oldest first, each in the stage that the last move left it in."""
    folder = f"{registry}/{name}"
    versions = {v: facts | {"version": v} for v, facts in _records(spark, f"{folder}/versions")}
    for _, move in _records(spark, f"{folder}/moves"):
        if move["alone"]:
            for facts in versions.values():
                if facts["stage"] == move["stage"]:
                    facts["stage"] = ARCHIVED
        if move["version"] in versions:
            versions[move["version"]]["stage"] = move["stage"]
    return [versions[v] for v in sorted(versions)]


def registered_models(spark: SparkSession, registry: str) -> DataFrame:
    """Every version in the registry folder with its present stage."""
    rows = [
        (name, v["version"], v["stage"], v["path"], v["run_id"], dt.datetime.fromisoformat(v["registered"]))
        for name in _names(spark, registry)
        for v in _versions(spark, registry, name)
    ]
    return spark.createDataFrame(rows, REGISTRY)


def register_model(
    spark: SparkSession,
    model: PipelineModel,
    name: str,
    registry: str,
    root: str,
    run_id: str | None = None,
    stage: str | None = None,
) -> int:
    """Save ``model`` under a new version and record it in the folder ``registry``; returns the version.

    The model is written first, then its number claimed, then the record put in
    place: a record always points to a whole model, and drivers that register
    the same name at once get different versions. A driver that dies in between leaves a number unused.
    """
    path = f"{root.rstrip('/')}/{name}/{uuid.uuid4().hex}"
    model.write().save(path)
    folder = f"{registry.rstrip('/')}/{name}/versions"
    version = _claim(spark, folder)
    now = dt.datetime.now().isoformat()
    _record(spark, folder, version, {"path": path, "run_id": run_id, "stage": stage, "registered": now})
    return version


def move_stage(
    spark: SparkSession, name: str, registry: str, version: int, stage: str | None, alone: bool = False
) -> None:
    """Move a version to ``stage``; ``alone`` archives what was in that stage, in the same step.

    One record is one move, so readers see the stages before or after it. Of
    two moves at once the one with the higher number counts last.
    """
    registry = registry.rstrip("/")
    if version not in {v["version"] for v in _versions(spark, registry, name)}:
        raise LookupError(f"no registered model {name!r} (version {version})")
    folder = f"{registry}/{name}/moves"
    _record(spark, folder, _claim(spark, folder), {"version": version, "stage": stage, "alone": alone})


def load_model(
    spark: SparkSession, name: str, registry: str, stage: str | None = None, version: int | None = None
) -> PipelineModel:
    """The newest version of a model, optionally of one stage, or a given version."""
    fitting = [
        v for v in _versions(spark, registry.rstrip("/"), name)
        if (stage is None or v["stage"] == stage) and (version is None or v["version"] == version)
    ]
    if not fitting:
        raise LookupError(f"no registered model {name!r} (stage {stage}, version {version})")
    return PipelineModel.load(fitting[-1]["path"])

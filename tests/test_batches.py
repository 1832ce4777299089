"""Stream targets by batch: replays, compaction beside a running stream, reports from folds."""

import pytest
from pyspark.sql import functions as F

from tiltwatch.config import LABELS, Settings, work_folder
from tiltwatch.plans import jobs
from tiltwatch.plans import reports as R
from tiltwatch.plans.documents import word_model
from tiltwatch.plans.gold import GoldStates, pending
from tiltwatch.sources import tables
from tiltwatch.sources.parts import Part, tail
from tiltwatch.streaming.batches import BatchTarget, score_into_batches
from tiltwatch.streaming.scoring import wait


@pytest.fixture(scope="module")
def database(spark):
    name = Settings("batch.tests").database
    tables.ensure_database(spark, name)
    yield name
    spark.sql("USE default")
    tables.drop_database(spark, name)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def target(spark):
    return BatchTarget(work_folder(spark, "batches"), work_folder(spark, "checkpoint"))


def chat(spark, start, n):
    return spark.range(start, start + n).select(
        (F.col("id") % 7).alias("match_id"), (F.col("id") % 10).cast("int").alias("slot"),
        (F.col("id") * 13 % 2000 - 100).cast("int").alias("time"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("message "), "id")).alias("key"), F.lit("u").alias("unit"),
    )


def stream(spark, source, to, **more):
    wait(score_into_batches(spark, source, to, word_model(), **more))


def test_replayed_batch_adds_nothing(spark, database):
    source, to = f"{database}.replayed", target(spark)
    chat(spark, 0, 60).repartition(3).write.saveAsTable(source)
    stream(spark, source, to, files_per_batch=1)
    before = rows(to.read(spark))
    assert len(before) == 60 and to.live(spark) == [Part(0, 0), Part(1, 1), Part(2, 2)] and to.committed(spark) == 2
    last = to.read(spark, [Part(2, 2)])
    again = spark.createDataFrame(last.collect(), last.schema)
    to.write_batch(again, 2)
    assert rows(to.read(spark)) == before
    stream(spark, source, to)
    assert rows(to.read(spark)) == before


def test_a_lost_commit_is_replayed(spark, database):
    """The driver dies after a batch is written and before it is committed: the batch runs again."""
    source, to = f"{database}.lost", target(spark)
    chat(spark, 0, 40).repartition(2).write.saveAsTable(source)
    stream(spark, source, to, files_per_batch=1)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{to.checkpoint}/commits/1")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(path, True)
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{to.checkpoint}/commits/.1.crc"), True)
    assert to.committed(spark) == 0 and to.compact(spark, whole=True) is None  # batch 1 may come again
    stream(spark, source, to, files_per_batch=1)
    assert to.read(spark).count() == 40 and to.committed(spark) == 1


def test_compaction_beside_a_stream_loses_nothing(spark, database):
    source, to = f"{database}.beside", target(spark)
    chat(spark, 0, 200).repartition(8).write.saveAsTable(source)
    seen = []

    def write(batch_rows, batch):
        to.write_batch(batch_rows, batch)
        if batch in (3, 6):  # the stream is in the middle of its batch
            seen.append((to.compact(spark, whole=True), to.read(spark).count()))

    new = spark.readStream.option("maxFilesPerTrigger", 1).table(source)
    wait(new.writeStream.foreachBatch(write).trigger(availableNow=True).option("checkpointLocation", to.checkpoint).start())
    assert [part for part, _ in seen] == [Part(0, 2), Part(0, 5)]
    want = rows(spark.table(source))
    assert rows(to.read(spark)) == want
    reader = to.read(spark)  # began before the next compaction
    assert to.compact(spark, whole=True) == Part(0, 7)
    assert rows(reader) == want == rows(to.read(spark))
    assert len(to.clean(spark)) == 10 and to.complete(spark) == [Part(0, 7)]
    assert rows(to.read(spark)) == want and len(to.read(spark).inputFiles()) == 1


def test_an_unfinished_compaction_does_not_count(spark, database):
    source, to = f"{database}.unfinished", target(spark)
    chat(spark, 0, 30).repartition(3).write.saveAsTable(source)
    stream(spark, source, to, files_per_batch=1)
    want = rows(to.read(spark))
    chat(spark, 0, 5).write.parquet(to.place(Part(0, 2)))
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{to.place(Part(0, 2))}/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).delete(marker, False)
    assert rows(to.read(spark)) == want
    assert to.compact(spark, whole=True) == Part(0, 2) and rows(to.read(spark)) == want


def test_wider_batches(spark, database):
    source, to = f"{database}.wider", target(spark)
    chat(spark, 0, 10).drop("unit").write.saveAsTable(source)
    stream(spark, source, to)
    tables.append_evolving(spark, chat(spark, 10, 10), source)
    stream(spark, source, to)
    assert to.compact(spark, whole=True) == Part(0, 1)
    found = to.read(spark)
    assert found.filter("unit IS NULL").count() == 10 == found.filter("unit = 'u'").count()


def test_tail_of_parts():
    parts = [Part(i, i) for i in range(6)]
    assert tail(parts, [100, 8, 4, 2, 1, 1]) == parts[1:]
    assert tail(parts, [1, 1, 1, 1, 1, 50]) == parts and tail(parts, [9, 9, 9, 9, 50, 9]) == []
    assert tail(parts, [100, 8, 4, 2, 1, 1], whole=True) == parts and tail(parts[:1], [1], whole=True) == []


def test_pending_ranges():
    p = Part
    assert pending([p(0, 0), p(1, 1)], []) == [(p(0, 0), [p(0, 0)]), (p(1, 1), [p(1, 1)])]
    assert pending([p(0, 1), p(2, 2)], [p(0, 0), p(1, 1)]) == [(p(2, 2), [p(2, 2)])]  # merged since, but folded
    assert pending([p(0, 3)], [p(0, 0), p(1, 1)]) == [(p(0, 3), [p(0, 3)])]
    assert pending([p(0, 2), p(3, 8)], [p(0, 5)]) == [(p(0, 8), [p(0, 2), p(3, 8)])]
    assert pending([], [p(0, 1)]) == [] and pending([p(4, 4)], []) == [(p(4, 4), [p(4, 4)])]


def scored(spark, start, n):
    labels = F.array(*(F.lit(x) for x in LABELS))
    return chat(spark, start, n).withColumnRenamed("key", "comment_text").withColumn(
        "predicted", F.filter(labels, lambda x, i: (F.col("match_id") + i * F.col("slot")) % 4 == 0)
    )


def test_gold_after_increments_equals_a_rebuild(spark, database):
    settings = Settings("batch.tests")
    players = spark.range(70).select((F.col("id") % 7).alias("match_id"), (F.col("id") + 1000).alias("account_id"), (F.col("id") / 7).cast("int").alias("player_slot"))
    tables.save_table(players, settings.table("toxicity_players"))
    tables.save_table(spark.range(7).select(F.col("id").alias("match_id"), (F.col("id") % 3).cast("int").alias("cluster")), settings.table("toxicity_match"))
    tables.save_table(spark.createDataFrame([(0, "EAST"), (1, "WEST"), (2, "EAST")], "cluster int, region string"), settings.table("toxicity_cluster_regions"))
    to, states = target(spark), GoldStates(work_folder(spark, "states"))
    source = f"{database}.scored_source"
    read = []
    for step in range(3):
        tables.append_evolving(spark, scored(spark, step * 300, 200 + step * 50).repartition(2), source)
        new = spark.readStream.option("maxFilesPerTrigger", 1).table(source)
        wait(new.writeStream.foreachBatch(to.write_batch).trigger(availableNow=True).option("checkpointLocation", to.checkpoint).start())
        known = set(map(to.place, to.live(spark)))
        read.append(states.update(spark, to))
        assert states.update(spark, to) == []  # nothing is read twice
        assert set(read[-1]) <= known and not set(read[-1]) & set(sum(read[:-1], []))
        if step < 2:
            states.merge(spark)
            states.clean(spark)
            to.compact(spark)
    published = jobs.publish_new(spark, settings, to, states)
    gold = {t: rows(spark.table(t)) for t in published}
    tables.save_table(to.read(spark), settings.table(jobs.SCORED))
    assert set(jobs.publish(spark, settings)) == set(published)
    assert gold == {t: rows(spark.table(t)) for t in published}
    assert [len(x) for x in read] == [2, 2, 2]
    assert rows(states.match_share_per_label(spark)) == rows(R.match_share_per_label(to.read(spark)))
    states.merge(spark, whole=True)
    states.clean(spark)
    assert [len(states.of(k).complete(spark)) for k in ("counts", "sizes", "seats", "matches")] == [1] * 4
    assert rows(states.label_count_histogram(spark)) == rows(R.label_count_histogram(to.read(spark)))


def test_streamed_files_go_with_the_table(spark, monkeypatch):
    from tiltwatch.plans import catalog

    parts = []
    append = catalog.append_evolving
    monkeypatch.setattr(catalog, "append_evolving", lambda s, df, t: parts.append(df.rdd.getNumPartitions()) or append(s, df, t))
    folder = "/root/testdata/sf0.001"
    want = sorted(map(tuple, catalog.all_queries()["match_share_per_label"](spark, folder).collect()))
    monkeypatch.setattr(catalog, "SORT_BYTES", -(-catalog.folder_bytes(spark, f"{folder}/lineitem.parquet") // 6))
    assert sorted(map(tuple, catalog.incremental_match_share(spark, folder).collect())) == want
    assert parts == [6, 6]

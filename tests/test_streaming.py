"""The streaming job against its batch twin, restarts and fresh starts."""

import pytest
from pyspark.sql import functions as F

from tiltwatch.config import Settings, work_folder
from tiltwatch.plans.documents import word_model
from tiltwatch.sources import layout, star, tables
from tiltwatch.streaming.scoring import StreamTarget, score_stream, score_table, wait

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database(spark):
    name = Settings("stream tests").database
    tables.ensure_database(spark, name)
    conversations = star.read(spark, FOLDER, "conversations").select(
        F.col("conv_id").alias("match_id"), F.col("turn").alias("slot"), F.col("text").alias("key")
    )
    documents = star.read(spark, FOLDER, "documents").select(
        F.col("doc_id").alias("match_id"), F.lit(0).cast("bigint").alias("slot"),
        F.col("text").alias("key"),
    )
    tables.save_table(conversations.unionByName(documents), f"{name}.toxicity_chat")
    yield name
    spark.sql("USE default")
    tables.drop_database(spark, name)


def rows(df):
    return sorted(tuple(r) for r in df.select("match_id", "slot", "predicted").collect())


def run(spark, source, target):
    query = score_stream(spark, source, target, word_model())
    assert wait(query, 120)


def test_stream_equals_batch_and_restarts_exactly_once(spark, database):
    source = f"{database}.toxicity_chat"
    target = StreamTarget(f"{database}.chat_stream", work_folder(spark, "checkpoint"))
    run(spark, source, target)
    score_table(spark, source, f"{database}.chat_batch", word_model())
    batch = spark.table(f"{database}.chat_batch")
    streamed = spark.table(target.table)
    assert sorted(streamed.columns) == sorted(batch.columns)
    assert rows(streamed) == rows(batch)
    assert any(r[2] for r in rows(streamed))

    run(spark, source, target)
    total = batch.count()
    assert spark.table(target.table).count() == total

    more = [(10**9 + i, i, "what an idiot") for i in range(10)]
    spark.createDataFrame(more, "match_id bigint, slot bigint, key string").write.insertInto(source)
    run(spark, source, target)
    spark.catalog.refreshTable(target.table)
    assert spark.table(target.table).count() == total + 10
    new = spark.table(target.table).filter(F.col("match_id") >= 10**9)
    assert all("toxic" in r[2] for r in rows(new)) and new.count() == 10

    fresh = target.fresh()
    assert fresh.table != target.table and fresh.checkpoint != target.checkpoint
    run(spark, source, fresh)
    assert spark.table(fresh.table).count() == total + 10
    assert spark.table(target.table).count() == total + 10

    with pytest.raises(ValueError, match="stream"):
        layout.compact_table(spark, target.table)


def test_stream_widens_an_existing_target(spark, database):
    source = f"{database}.narrow_source"
    df = spark.createDataFrame([(1, 0, "idiot", "u")], "match_id bigint, slot bigint, key string, unit string")
    tables.save_table(df, source)
    target = StreamTarget(f"{database}.widened", work_folder(spark, "checkpoint"))
    spark.sql(f"CREATE TABLE {target.table} (match_id bigint, comment_text string) USING parquet")
    run(spark, source, target)
    got = spark.table(target.table)
    assert {"slot", "unit", "predicted"} <= set(got.columns)
    assert rows(got) == [(1, 0, ["toxic", "low_quality"])]


def test_stream_into_rows_of_another_writer_is_refused(spark, database):
    source, taken = f"{database}.refused_source", f"{database}.refused"
    df = spark.createDataFrame([(1, 0, "gg")], "match_id bigint, slot bigint, key string")
    tables.save_table(df, source)
    score_table(spark, source, taken, word_model())
    with pytest.raises(ValueError, match="no stream wrote"):
        run(spark, source, StreamTarget(taken, work_folder(spark, "checkpoint")))
    assert spark.table(taken).count() == 1


def test_failure_in_the_stream_is_raised(spark, database):
    source = f"{database}.bad_source"
    tables.save_table(spark.createDataFrame([("x",)], "key string"), source)
    broken = spark.readStream.table(source).select(
        F.raise_error(F.lit("broken row")).cast("string").alias("key")
    )
    target = StreamTarget(f"{database}.bad", work_folder(spark, "checkpoint"))
    query = score_stream(spark, broken, target, word_model())
    with pytest.raises(Exception, match="broken row"):
        wait(query)

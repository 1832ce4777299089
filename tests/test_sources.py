"""CSV, tables and file layout, each in folders of its own."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tiltwatch import schemas
from tiltwatch.config import Settings, work_folder
from tiltwatch.plans import reports as R
from tiltwatch.sources import layout, tables
from tiltwatch.sources.csv import load_csv, write_csv
from tiltwatch.sources.split_csv import load_all, load_split_csv


@pytest.fixture(scope="module")
def database(spark):
    name = Settings("source.tests").database
    tables.ensure_database(spark, name)
    yield name
    spark.sql("USE default")
    tables.drop_database(spark, name)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_quotes_newlines_and_empty_fields(spark, tmp_path):
    header = "id,comment_text," + ",".join(schemas.COMMENTS.names[2:])
    body = '1,"a ""q"" b\nline2",0,0,0,0,0,1\n2,,1,0,0,0,0,0\n'
    (tmp_path / "train.csv").write_text(f"{header}\n{body}")
    df = load_csv(spark, str(tmp_path / "train.csv"), schemas.COMMENTS)
    assert [f.dataType.simpleString() for f in df.schema] == ["string"] * 2 + ["int"] * 6
    assert rows(df.select("id", "comment_text", "toxic", "identity_hate")) == [
        ("1", 'a "q" b\nline2', 0, 1),
        ("2", None, 1, 0),
    ]


def test_csv_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "chat.csv").write_text('time,extra,key,match_id\n-5,x,"hi, all",7\n')
    df = load_csv(spark, str(tmp_path / "chat.csv"), schemas.CHAT)
    assert df.dtypes == [
        ("time", "int"), ("extra", "string"), ("key", "string"), ("match_id", "bigint")
    ]
    assert rows(df) == [(-5, "x", "hi, all", 7)]


def test_single_line_csv_is_split(spark, tmp_path):
    lines = "".join(f'{i},"{i % 7}"\n' for i in range(20_000))
    (tmp_path / "match.csv").write_text("match_id,cluster\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
        whole = load_csv(spark, str(tmp_path / "match.csv"), schemas.MATCH)
        split = load_csv(spark, str(tmp_path / "match.csv"), schemas.MATCH, multi_line=False)
        parts = split.select(F.spark_partition_id()).distinct().count()
        assert whole.select(F.spark_partition_id()).distinct().count() == 1 < parts
        assert rows(split) == rows(whole)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_bad_number_fails_the_job(spark, tmp_path):
    (tmp_path / "m.csv").write_text("match_id,cluster\n1,east\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        load_csv(spark, str(tmp_path / "m.csv"), schemas.MATCH).collect()


def test_csv_round_trip_keeps_odd_text(spark):
    odd = [(1, ' lead and trail '), (2, 'q"q'), (3, "a\r\nb"), (4, "back\\slash"), (5, None), (6, "ü,😀")]
    df = spark.createDataFrame(odd, "id bigint, text string")
    folder = work_folder(spark, "csv-test")
    write_csv(df, folder)
    assert rows(load_csv(spark, folder, df.schema)) == rows(df)


def test_load_all(spark, database, tmp_path):
    (tmp_path / "players.csv").write_text("match_id,account_id,player_slot\n1,5,0\n")
    (tmp_path / "match_outcomes.csv").write_text("match_id,rad_win\n1,0\n")
    names = load_all(spark, str(tmp_path), database, ["players", "match_outcomes"])
    assert names == [f"{database}.toxicity_players", f"{database}.toxicity_match_outcomes"]
    assert rows(spark.table(names[0])) == [(1, 5, 0)]
    # Columns nobody typed stay text.
    assert spark.table(names[1]).dtypes == [("match_id", "string"), ("rad_win", "string")]
    load_all(spark, str(tmp_path), database, ["players"])
    assert spark.table(names[0]).count() == 1


def test_database_is_kept_and_tables_are_replaced(spark, database):
    table = f"{database}.numbers"
    tables.save_table(spark.range(3), table)
    tables.ensure_database(spark, database)
    tables.save_table(spark.range(5), table)
    assert spark.table("numbers").count() == 5
    tables.drop_table(spark, table)
    assert not spark.catalog.tableExists(table)


def test_gold_table_is_one_file(spark, database):
    chat = spark.range(100, numPartitions=7).select(F.array(F.lit("toxic")).alias("predicted"))
    tables.save_gold(R.messages_per_label(chat), f"{database}.gold_labels")
    saved = spark.table(f"{database}.gold_labels")
    assert len(saved.inputFiles()) == 1
    assert dict(rows(saved))["Toxic"] == 100


def test_append_evolving(spark, database):
    table = f"{database}.evolving"
    tables.append_evolving(spark, spark.createDataFrame([(1, "a")], "id int, t string"), table)
    wider = spark.createDataFrame([("b", 2, [0.5])], "t string, id int, score array<double>")
    tables.append_evolving(spark, wider, table)
    narrower = spark.createDataFrame([(3,)], "ID int")
    tables.append_evolving(spark, narrower, table)
    assert rows(spark.table(table)) == [(1, "a", None), (2, "b", [0.5]), (3, None, None)]


def small_files(spark, table):
    data = spark.range(2_000).select(
        (F.col("id") * 7 % 300).alias("match_id"), F.col("id").cast("string").alias("t")
    )
    data.repartition(40).write.mode("overwrite").saveAsTable(table)


def test_compact_table(spark, database):
    table = f"{database}.loose"
    small_files(spark, table)
    before = rows(spark.table(table))
    assert len(spark.table(table).inputFiles()) == 40
    previous = layout.compact_table(spark, table)
    assert len(spark.table(table).inputFiles()) < 10
    assert rows(spark.table(table)) == before == rows(spark.table(previous))
    assert layout.compact_table(spark, table) != previous


def test_clustered_compaction_narrows_files(spark, database):
    table = f"{database}.clustered"
    small_files(spark, table)
    before = rows(spark.table(table))
    size = layout.folder_bytes(spark, layout.table_folder(spark, table))
    layout.compact_table(spark, table, cluster_by=["match_id"], file_bytes=size // 4)
    assert rows(spark.table(table)) == before
    per_file = (
        spark.table(table)
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("match_id").alias("low"), F.max("match_id").alias("high"))
        .orderBy("low")
        .collect()
    )
    assert 3 <= len(per_file) <= 5
    assert all(a["high"] <= b["low"] for a, b in zip(per_file, per_file[1:]))


def test_clustering_splits_a_hot_value(spark, database):
    table = f"{database}.hot"
    data = spark.range(9_000).select(
        F.when(F.col("id") % 3 < 2, 5).otherwise(F.col("id")).alias("match_id")
    )
    data.coalesce(1).write.mode("overwrite").saveAsTable(table)
    spread = layout.clustered(spark.table(table), ["match_id"], 6)
    sizes = spread.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) == 6 and max(r["count"] for r in sizes) < 3_000
    assert spread.filter("match_id = 5").count() == 6_000 + 1


def test_work_folder_is_shared_and_new(spark):
    first, second = work_folder(spark, "x"), work_folder(spark, "x")
    assert first != second
    assert first.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_overwriting_a_table_from_itself_is_refused(spark, database):
    table = f"{database}.selfread"
    tables.save_table(spark.range(3), table)
    with pytest.raises(AnalysisException):
        tables.save_table(spark.table(table).filter("id > 0"), table)
    assert spark.table(table).count() == 3


@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_files_with_another_header_order_fail(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text("id,x\n1,10\n")
    (tmp_path / "b.csv").write_text("x,id\n20,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_csv(spark, str(tmp_path), multi_line=multi_line).collect()
    (tmp_path / "b.csv").write_text("id,x\n2,20\n")
    assert rows(load_csv(spark, str(tmp_path), multi_line=multi_line)) == [("1", "10"), ("2", "20")]


def test_compaction_honours_the_file_size(spark, tmp_path):
    spark.range(200_000).repartition(12).write.parquet(str(tmp_path / "in"))
    size = layout.folder_bytes(spark, str(tmp_path / "in"))
    for files in (1, 4):
        out = str(tmp_path / f"out{files}")
        layout.compact_files(spark, str(tmp_path / "in"), out, file_bytes=-(-size // files))
        assert len(spark.read.parquet(out).inputFiles()) == files
        assert spark.read.parquet(out).agg(F.sum("id")).first()[0] == sum(range(200_000))


def test_a_lost_swap_is_recovered(spark, database):
    table = f"{database}.swapped"
    spark.range(5).write.mode("overwrite").saveAsTable(f"{table}_new_ab")
    spark.range(4).write.mode("overwrite").saveAsTable(f"{table}_old_ab")
    assert layout.recover_table(spark, table) and not layout.recover_table(spark, table)
    assert spark.table(table).count() == 5
    layout.drop_previous(spark, f"{table}_old_ab")
    assert not spark.catalog.tableExists(f"{table}_old_ab")

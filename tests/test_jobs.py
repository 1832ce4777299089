"""From CSV files to gold tables: all jobs in a row."""

import pytest
from pyspark.sql import functions as F

from tiltwatch.config import LABELS, Settings, work_folder
from tiltwatch.models.tracking import load_model
from tiltwatch.plans import jobs
from tiltwatch.sources import tables
from tiltwatch.streaming.scoring import StreamTarget, wait

WORDS = dict(zip(LABELS, ("awful", "dreadful", "rude", "beware", "fool", "kind")))


@pytest.fixture(scope="module")
def settings(spark):
    chosen = Settings("jobs.test")
    yield chosen
    spark.sql("USE default")
    tables.drop_database(spark, chosen.database)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    comments = ["id,comment_text," + ",".join(LABELS)]
    for i in range(300):
        flags = [int(i % (k + 2) == 0) for k in range(6)]
        said = " ".join(w for w, f in zip(WORDS.values(), flags) if f)
        comments.append(f'{i:04d},"well ""{said}""\nn{i % 11}",' + ",".join(map(str, flags)))
    (folder / "train.csv").write_text("\n".join(comments) + "\n")
    (folder / "test.csv").write_text('id,comment_text\n1,"a, b"\n')
    chat = ["match_id,key,slot,time,unit"]
    for match in range(20):
        for slot in range(10):
            word = list(WORDS.values())[slot] if slot < 6 else "gg"
            chat.append(f'{match},"{word}, {slot}",{slot},{match * 150 - 100},u{slot}')
    (folder / "chat.csv").write_text("\n".join(chat) + "\n")
    players = ["match_id,account_id,player_slot"]
    players += [f"{m},{1000 + s},{s}" for m in range(20) for s in range(10)]
    (folder / "players.csv").write_text("\n".join(players) + "\n")
    (folder / "match.csv").write_text(
        "match_id,cluster\n" + "".join(f"{m},{m % 3}\n" for m in range(20))
    )
    (folder / "cluster_regions.csv").write_text("cluster,region\n0,EAST\n1,WEST\n2,EAST\n")
    (folder / "match_outcomes.csv").write_text("match_id,rad_win\n1,0\n")
    (folder / "player_ratings.csv").write_text("account_id,wins\n1,0\n")
    return str(folder)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_whole_run(spark, settings, folder):
    assert len(jobs.load(spark, settings, folder)) == 8
    by_region, by_account = jobs.raw_activity(spark, settings)
    assert rows(by_region) == [("EAST", 10, 1300), ("WEST", 10, 700)]
    assert rows(by_account)[0] == (1000, 20)

    version = jobs.train(
        spark,
        settings,
        work_folder(spark, "models"),
        dimensions=1 << 10,
        penalty=0.001,
        max_iter=8,
    )
    assert version == 1
    run = spark.table(settings.table(jobs.RUNS)).first()
    assert run["metrics"]["f1"] > 0.9 and run["params"]["penalty"] == "0.001"

    chosen = {"dimensions": 1 << 10, "penalty": 0.001, "max_iter": 8}
    second = jobs.train(spark, settings, work_folder(spark, "models"), stage="Trial", choose=True, **chosen)
    assert second == 2
    run = spark.table(settings.table(jobs.RUNS)).orderBy(F.desc("started")).first()
    assert run["metrics"]["f1"] > 0.9
    logged = {k: float(v) for k, v in run["params"].items() if k.startswith("threshold_")}
    assert set(logged) == {f"threshold_{x}" for x in LABELS}
    loaded = load_model(spark, settings.model_name, jobs.registry_folder(spark, settings), "Trial")
    assembler = loaded.stages[-1].stages[-1]
    assert dict(zip(LABELS, assembler.getOrDefault("thresholds"))) == {x: logged[f"threshold_{x}"] for x in LABELS}

    jobs.score_batch(spark, settings, partitions=4)
    scored = spark.table(settings.table(jobs.SCORED))
    assert scored.columns == ["match_id", "comment_text", "slot", "time", "unit", "predicted"]
    shown = jobs.preview(spark, settings)
    assert shown.columns == scored.columns and shown.count() == min(10, scored.count())
    assert shown.exceptAll(scored).count() == 0

    target = StreamTarget(settings.table("toxicity_chat_stream"), work_folder(spark, "checkpoint"))
    assert wait(jobs.score_new(spark, settings, target, files_per_batch=1), 120)
    assert sorted(map(str, rows(spark.table(target.table)))) == sorted(map(str, rows(scored)))

    published = jobs.publish(spark, settings)
    assert len(published) == 13
    wanted = jobs.reports(spark, settings)
    for name in wanted:
        table, report = settings.table(f"gold_{name}"), wanted[name]
        assert table in published and spark.table(table).columns == report.columns
        assert sorted(map(str, rows(spark.table(table)))) == sorted(map(str, rows(report)))
    gold = {t.rpartition("gold_")[2]: rows(spark.table(t)) for t in published}
    assert dict(gold["messages_per_label"])["Toxic"] == 20
    assert gold["toxic_regions_top5"] == [("EAST", 10, 130), ("WEST", 10, 70)]
    assert gold["toxic_regions_authored"] == [("EAST", 1, 13), ("WEST", 1, 7)]
    assert gold["toxic_players_top10"] == [(1000, 20)]
    assert dict(gold["toxic_timeline"])["Game_Lobby"] == 1
    assert ("Toxic", 20, 100.0) in gold["match_share_per_label"]

"""Text stages, the multi-label classifier, run log and registry."""

import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from tiltwatch.config import LABELS, Settings, work_folder
from tiltwatch.functions.labels import prepare_labels
from tiltwatch.functions.split import hash_split
from tiltwatch.models.classifier import LEAST_TASKS, fit_report, text_classifier, with_thresholds
from tiltwatch.models import tracking, word_vectors
from tiltwatch.models.text import learned_encoder, least_count, sentence_encoder
from tiltwatch.models.tracking import ARCHIVED, Run, load_model, move_stage, register_model, registered_models
from tiltwatch.operators.metrics import label_scores
from tiltwatch.operators.thresholds import best_thresholds, choose_thresholds, score_histogram
from tiltwatch.plans.documents import COMMENT_LABELS, comment_labels, fit_comments
from tiltwatch.sources import star, tables
from tiltwatch.streaming.scoring import score

WORDS = dict(zip(LABELS, ("awful", "dreadful", "rude", "beware", "fool", "kind")))


@pytest.fixture(scope="module")
def database(spark):
    name = Settings("model tests").database
    tables.ensure_database(spark, name)
    yield name
    spark.sql("USE default")
    tables.drop_database(spark, name)


@pytest.fixture(scope="module")
def training(spark):
    """Each label has one word that gives it away."""
    flags = {
        label: (F.col("id") % (i + 2) == 0).cast("int") for i, label in enumerate(LABELS)
    }
    words = [F.when(flags[x] == 1, F.lit(WORDS[x])) for x in LABELS]
    text = F.concat_ws(" ", F.lit("well"), *words, F.concat(F.lit("n"), F.col("id") % 11))
    return prepare_labels(
        spark.range(400).select(
            "id", text.alias("comment_text"), *[flags[x].alias(x) for x in LABELS]
        )
    )


@pytest.fixture(scope="module")
def model(training):
    return text_classifier(LABELS, dimensions=1 << 10, penalty=0.001).fit(training)


def chat(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "match_id bigint, key string")


def predicted(df):
    return [r["predicted"] for r in df.orderBy("match_id").collect()]


def test_tokens_and_vector(spark):
    df = spark.createDataFrame(
        [(0, "Çà va, GG-2 ça!"), (1, None), (2, "")], "id int, comment_text string"
    )
    encoded = sentence_encoder().transform(df).orderBy("id").collect()
    assert encoded[0]["token"] == ["çà", "va", "gg", "2", "ça"]
    assert encoded[1]["token"] == [] == encoded[2]["token"]
    assert encoded[0]["universal_embeddings"].size == 1 << 16
    assert encoded[0]["universal_embeddings"].numNonzeros() == 5
    dense = sentence_encoder(dimensions=512, dense=True).transform(df).orderBy("id").collect()
    assert dense[0]["universal_embeddings"].norm(2) == pytest.approx(1.0)
    assert dense[1]["universal_embeddings"].numNonzeros() == 0
    assert "token_counts" not in dense[0]


def test_every_label_is_learned(spark, model):
    texts = [f"well {WORDS[x]} n1" for x in LABELS]
    got = predicted(score(chat(spark, *texts, "well n1", None, "fool and rude"), model))
    assert got[:6] == [[x] for x in LABELS]
    assert got[6] == [] and got[7] == []
    assert got[8] == ["obscene", "insult"]


def test_score_output_columns(spark, model):
    scored = score(chat(spark, "awful"), model)
    assert scored.dtypes == [
        ("match_id", "bigint"), ("comment_text", "string"), ("predicted", "array<string>")
    ]
    spread = score(chat(spark, "awful", "kind"), model, partitions=3)
    assert predicted(spread) == [["toxic"], ["identity_hate"]]


def test_class_holds_results_with_confidence(spark, model):
    row = model.transform(chat(spark, "awful").withColumnRenamed("key", "comment_text")).first()
    assert row["class"][0]["result"] == "toxic" and row["class"][0]["confidence"] > 0.7


def test_no_python_worker_in_the_scoring_plan(spark, model):
    plan = score(chat(spark, "a"), model)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_label_without_examples(spark, training):
    fitted = text_classifier(("toxic", "unseen"), dimensions=1 << 10).fit(training)
    assert predicted(score(chat(spark, "awful", "well"), fitted)) == [["toxic"], []]


def test_save_and_load_give_the_same(spark, model):
    path = work_folder(spark, "model")
    model.write().save(path)
    texts = chat(spark, *[f"{a} {b}" for a in WORDS.values() for b in WORDS.values()])
    loaded = PipelineModel.load(path)
    assert predicted(score(texts, loaded)) == predicted(score(texts, model))


@pytest.fixture(scope="module")
def small_model(training):
    settings = {"dimensions": 1 << 8, "penalty": 0.001, "max_iter": 5}
    return text_classifier(("toxic",), **settings).fit(training)


def test_registry_and_run_log(spark, database, small_model):
    model = small_model
    runs, models = f"{database}.model_runs", work_folder(spark, "models")
    assert registered_models(spark, models).count() == 0
    with Run(spark, runs, "toxicity") as run:
        run.log_param("threshold", 0.7)
        run.log_metric("f1", 0.5)
    root = work_folder(spark, "registry")
    assert register_model(spark, model, "tox", models, root, run.run_id) == 1
    assert register_model(spark, model, "tox", models, root, run.run_id, stage="Production") == 2
    assert register_model(spark, model, "tox", models, root) == 3
    assert register_model(spark, model, "other", models, root) == 1
    logged = spark.table(runs).first()
    assert logged["params"] == {"threshold": "0.7"} and logged["metrics"] == {"f1": 0.5}
    assert logged["run_id"] == run.run_id and logged["ended"] >= logged["started"]
    loaded = load_model(spark, "tox", models, stage="Production")
    assert predicted(score(chat(spark, "awful"), loaded)) == [["toxic"]]
    assert load_model(spark, "tox", models).uid == model.uid
    assert load_model(spark, "tox", models, version=1).uid == model.uid
    with pytest.raises(LookupError):
        load_model(spark, "none", models)


def test_drivers_that_register_at_once_get_versions_of_their_own(spark, small_model):
    registry, root = work_folder(spark, "models"), work_folder(spark, "registry")
    with ThreadPoolExecutor(4) as pool:
        got = list(pool.map(lambda _: register_model(spark, small_model, "tox", registry, root), range(8)))
    assert sorted(got) == list(range(1, 9))
    rows = registered_models(spark, registry).collect()
    assert sorted(r["version"] for r in rows) == list(range(1, 9)) and len({r["path"] for r in rows}) == 8


def test_a_claim_without_a_record_is_no_version(spark, small_model):
    registry, root = work_folder(spark, "models"), work_folder(spark, "registry")
    assert register_model(spark, small_model, "tox", registry, root) == 1
    assert tracking._claim(spark, f"{registry}/tox/versions") == 2  # a driver that died here
    assert [r["version"] for r in registered_models(spark, registry).collect()] == [1]
    assert register_model(spark, small_model, "tox", registry, root) == 3


def test_stage_moves(spark, small_model):
    registry, root = work_folder(spark, "models"), work_folder(spark, "registry")
    for stage in ("Production", None, None):
        register_model(spark, small_model, "tox", registry, root, stage=stage)

    def stages():
        return [r["stage"] for r in registered_models(spark, registry).orderBy("version").collect()]

    assert stages() == ["Production", None, None]
    move_stage(spark, "tox", registry, 2, "Production", alone=True)
    assert stages() == [ARCHIVED, "Production", None]
    move_stage(spark, "tox", registry, 3, "Production")
    assert stages() == [ARCHIVED, "Production", "Production"]
    assert load_model(spark, "tox", registry, stage="Production").uid == small_model.uid
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda v: move_stage(spark, "tox", registry, v, "Production", alone=True), (1, 2, 3)))
    assert sorted(stages()) == [ARCHIVED, ARCHIVED, "Production"]  # whichever came last, it stands alone
    move_stage(spark, "tox", registry, 1, None)
    assert stages()[0] is None
    with pytest.raises(LookupError):
        move_stage(spark, "tox", registry, 9, "Production")


def test_failed_run_is_logged_as_failed(spark, database):
    runs = f"{database}.failed_runs"
    with pytest.raises(ZeroDivisionError):
        with Run(spark, runs, "x") as run:
            run.log_param("threshold", 0.7)
            1 / 0
    logged = spark.table(runs).collect()
    assert [r["status"] for r in logged] == ["failed"]
    assert logged[0]["params"] == {"threshold": "0.7"} and logged[0]["metrics"] == {}


def test_threshold_per_label(spark, training):
    settings = {"dimensions": 1 << 8, "max_iter": 3, "thresholds": {"toxic": 0.0, "threat": 1.0}}
    fitted = text_classifier(("toxic", "threat"), **settings).fit(training)
    assert predicted(score(chat(spark, "beware", "awful"), fitted)) == [["toxic"], ["toxic"]]
    assert fit_report(fitted, 3).keys() == {
        f"{kind}_{label}" for kind in ("iterations", "converged") for label in ("toxic", "threat")
    }


def brute_threshold(rows, label, bins):
    best = None
    for b in range(-1, bins):
        chosen = [truth for score, truth in rows if score > b / bins or (b < 0)]
        right = sum(label in (t or ()) for t in chosen)
        positives = sum(label in (t or ()) for _, t in rows)
        f1 = 2 * right / (len(chosen) + positives) if positives else None
        if f1 is not None and any((b < score * bins <= b + 1) for score, _ in rows) and (best is None or f1 >= best[0]):
            best = (f1, b / bins)
    return best


def test_thresholds_like_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        truth = None if i % 50 == 0 else [x for x in ("a", "b") if rng.random() < 0.4]
        rows.append((i, [(x, min(1.0, max(0.0, rng.gauss(0.7 if x in (truth or ()) else 0.3, 0.2)))) for x in ("a", "b", "c")], truth))
    rows += [(900, [("a", 0.0), ("b", 1.0)], ["b"]), (901, [], ["a"]), (902, None, [])]
    df = spark.createDataFrame(rows, "id int, class array<struct<result:string,confidence:double>>, labels array<string>")
    found = best_thresholds(score_histogram(df, F.col("class"), F.col("labels"), ("a", "b", "c"), 50), 50).collect()
    assert {r["label"] for r in found} == {"a", "b"}  # nothing carries c
    for r in found:
        scores = [(dict((x[0], x[1]) for x in c or ()).get(r["label"], 0.0), t) for _, c, t in rows]
        f1, threshold = brute_threshold(scores, r["label"], 50)
        assert r["f1"] == pytest.approx(f1) and r["threshold"] == pytest.approx(threshold)
    assert choose_thresholds(df.limit(0), F.col("class"), F.col("labels"), ("a",)) == {}


def test_chosen_thresholds_are_kept_with_the_model(spark, model):
    changed = with_thresholds(model, {"toxic": 0.999999, "insult": -1.0})
    path = work_folder(spark, "model")
    changed.write().save(path)
    texts = chat(spark, "awful", "rude")
    for fitted in (changed, PipelineModel.load(path)):
        assert predicted(score(texts, fitted)) == [["insult"], ["obscene", "insult"]]
    assert predicted(score(texts, model)) == [["toxic"], ["obscene"]]  # the given model is as it was


def test_assembled_features_carry_no_names(training):
    fitted = text_classifier(("toxic",), dimensions=1 << 8, text_features=True, max_iter=2).fit(training)
    features = training
    for stage in fitted.stages[:-1]:
        features = stage.transform(features)
    assert features.schema["features"].metadata == {} and features.first()["features"].size == 256 + 5


def test_learned_vectors(spark):
    documents = star.read(spark, "/root/testdata/sf0.01", "documents").filter("lang IS NOT NULL")
    encoder = learned_encoder(documents, "text", dimensions=32, max_words=3000)
    words = encoder.stages[-1].getVectors()
    assert 1000 < words.count() <= 3000
    rows = encoder.transform(documents).select("doc_id", "lang", "universal_embeddings").collect()
    unit = {r["doc_id"]: (r["lang"], np.array(r["universal_embeddings"])) for r in rows}
    unit = {d: (lang, v / np.linalg.norm(v)) for d, (lang, v) in unit.items() if v.any()}
    # Texts of a language use the same words, so their means lie together: the nearest mean tells it.
    learn, test = ([x for d, x in unit.items() if d % 2 == k] for k in (0, 1))
    means = {lang: np.mean([v for x, v in learn if x == lang], axis=0) for lang in {x for x, _ in learn}}
    right = sum(max(means, key=lambda m: v @ means[m]) == lang for lang, v in test)
    assert right > 0.95 * len(test)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "zzzzqqq")], "id int, text string")
    assert all(not r["universal_embeddings"].toArray().any() for r in encoder.transform(odd).collect())


def test_learned_vectors_do_not_depend_on_parts_or_order(spark):
    documents = star.read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    found = []
    for docs in (documents.coalesce(1), documents.repartition(7).orderBy(F.desc("doc_id"))):
        words = learned_encoder(docs, "text", dimensions=16, max_words=500).stages[-1].getVectors()
        found.append({r["word"]: tuple(r["vector"]) for r in words.collect()})
    assert len(found[0]) > 100 and found[0] == found[1]


def test_neighbours_are_counted_as_by_hand(spark):
    rng = random.Random(4)
    texts = [[rng.choice("abcdexyz") for _ in range(n)] for n in (0, 1, 2, 3, 40, 9, 200, 1)] + [["a"] * 30, ["x"] * 5]
    words, window = list("edcba"), 3
    expected = {}
    for text in texts:
        known = [words.index(w) for w in text if w in words]
        for i, x in enumerate(known):
            for d in range(1, min(window, len(known) - 1 - i) + 1):
                pair = tuple(sorted((x, known[i + d])))
                expected[pair] = expected.get(pair, 0) + window - d + 1
    tokens = spark.createDataFrame([(t,) for t in texts], "token array<string>").coalesce(1)
    for step in (7, 1 << 20):
        counts = word_vectors.neighbour_counts(tokens, words, window, step)
        rows = counts.collect()
        assert {(r["a"], r["b"]): r["n"] for r in rows} == expected and len(rows) == len(expected)
    full = np.zeros((len(words), len(words)))
    for (a, b), n in expected.items():
        full[a, b] += n
        full[b, a] += n
    unpacked = np.zeros_like(full)
    lists = word_vectors.neighbour_rows(counts).cache()
    for r in lists.collect():
        for x in r["x"]:
            unpacked[r["a"], x >> word_vectors.SHIFT] += x % (1 << word_vectors.SHIFT)
    assert (unpacked == full).all()
    smooth = full.sum(axis=0) ** word_vectors.SMOOTHING
    information = np.log(np.maximum(full, 1e-300) / np.outer(full.sum(axis=1), smooth / smooth.sum())).clip(min=0)
    right = np.random.default_rng(1).standard_normal((len(words), 2))
    assert np.allclose(word_vectors.times(lists, full.sum(axis=1), right), information @ right, atol=1e-4)


def test_learned_vectors_of_odd_tables(spark):
    schema = "doc_id int, text string"
    for texts in ([None, "", "!"], ["once only"]):
        with pytest.raises(ValueError, match="no word"):
            learned_encoder(spark.createDataFrame(list(enumerate(texts)), schema), "text")
    # Fewer words than dimensions; "alone" has no neighbour.
    docs = spark.createDataFrame([*enumerate(["red blue green"] * 5 + ["alone"] * 5), (None, None)], schema)
    encoder = learned_encoder(docs, "text", dimensions=8)
    path = work_folder(spark, "encoder")
    encoder.write().save(path)
    for model in (encoder, PipelineModel.load(path)):
        vectors = {r["text"]: r["universal_embeddings"].toArray() for r in model.transform(docs).collect()}
        assert all(v.shape == (8,) and np.isfinite(v).all() for v in vectors.values())
        assert vectors["red blue green"].any() and not vectors["alone"].any() and not vectors[None].any()
        assert model.stages[-1].findSynonyms("red", 2).count() == 2


def test_least_count_bounds_the_vocabulary(spark):
    tokens = spark.createDataFrame([(["a"] * 5 + ["b"] * 3 + ["c"] * 3 + ["d"],)], "token array<string>")
    assert [least_count(tokens, n, 1) for n in (1, 2, 3, 4, 9)] == [4, 4, 2, 1, 1]
    assert least_count(tokens, 9, 3) == 3 and least_count(tokens.limit(0), 5, 2) == 2


def test_quality_on_labelled_documents(spark):
    comments = comment_labels(star.comments(spark, "/root/testdata/sf0.1"))
    train, validation = hash_split(comments, "doc_id")
    fitted = fit_comments(train)
    scores = label_scores(score(validation, fitted), "labels", "predicted", COMMENT_LABELS)
    toxic = scores.filter("label = 'toxic'").first()
    assert toxic["precision"] > 0.85 and toxic["recall"] > 0.6
    quality = scores.filter("label = 'low_quality'").first()
    assert quality["precision"] > 0.7 and quality["recall"] > 0.5


def test_solver_tasks_do_not_grow_with_the_partitions(spark, training, monkeypatch):
    seen = []
    fit = LogisticRegression.fit
    monkeypatch.setattr(LogisticRegression, "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    settings = {"spark.sql.shuffle.partitions": "90", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        text_classifier(("toxic", "threat"), dimensions=1 << 8, max_iter=2).fit(training)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(seen) == 2 and max(seen) <= max(LEAST_TASKS, 2 * spark.sparkContext.defaultParallelism) < 90

"""Label functions, counts, ranges, split and measures on small rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import MultilabelClassificationEvaluator
from pyspark.sql import functions as F

from tiltwatch.config import LABELS, TIMELINE, Settings, display_name, sql_name
from tiltwatch.functions.labels import label_set, label_vector, prepare_labels
from tiltwatch.functions.split import hash_split, split_part
from tiltwatch.operators.counts import labelled_counts, labelled_distinct_counts, top_k
from tiltwatch.operators.metrics import document_scores, label_scores, macro_f1
from tiltwatch.operators.range_counts import range_counts


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_names():
    assert sql_name("ann.b-c d") == "ann_b_c_d"
    assert Settings("ann.b").database == "gaming_ann_b"
    assert Settings("x").table("t") == "gaming_x.t"
    assert display_name("severe_toxic") == "Severe_toxic"
    assert len(TIMELINE) == 7


def test_prepare_labels(spark):
    flags = [("a", "1", "0", "0", "0", "1", "0"), ("b", *"000000"), ("c", *"111111")]
    schema = "comment_text string, " + ", ".join(f"{x} string" for x in LABELS)
    prepared = prepare_labels(spark.createDataFrame(flags, schema))
    first, second, third = prepared.orderBy("comment_text").collect()
    assert first["labels"] == ["toxic", "insult"]
    assert first["label_true"] == [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]
    assert first["toxic_true"] == "1"
    assert second["labels"] == [] and second["label_true"] == [0.0] * 6
    assert third["labels"] == list(LABELS)
    kept = prepare_labels(spark.createDataFrame(flags, schema), drop_unlabelled=True)
    assert kept.count() == 2


def test_prepare_labels_with_numbers_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (0, 1)], "toxic int, threat int")
    got = [tuple(r) for r in prepare_labels(df, ("toxic", "threat")).collect()]
    assert got[0] == (1, None, ["toxic"], [1.0, None])
    assert got[1] == (0, 1, ["threat"], [0.0, 1.0])


def test_label_set_and_vector(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    got = df.select(
        label_set({"a": F.col("x") == 1, "b": F.col("x").isNull()}).alias("s")
    ).select("s", label_vector("s", ("a", "b")).alias("v"))
    assert [tuple(r) for r in got.collect()] == [(["a"], [1.0, 0.0]), (["b"], [0.0, 1.0])]


def test_labelled_counts(spark):
    df = spark.range(10)
    got = labelled_counts(df, {"even": F.col("id") % 2 == 0, "big": F.col("id") > 99}, "k", "n")
    assert rows(got) == [("big", 0), ("even", 5)]


def test_distinct_counts_equal_count_distinct(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), (F.col("id") % 5).alias("v"))
    conditions = {"low": F.col("v") < 2, "k3": F.col("k") == 3}
    got = dict(rows(labelled_distinct_counts(df, "k", conditions, "c", "n")))
    for name, condition in conditions.items():
        expected = df.filter(condition).agg(F.count_distinct("k")).first()[0]
        assert got[name] == expected


def test_top_k_breaks_ties(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3)], "k string, n int")
    assert [r["k"] for r in top_k(df, "n", 2, ["k"]).collect()] == ["c", "a"]


RANGES = "name string, low bigint, high bigint"


def test_range_counts_open_ends_overlap_and_zero(spark):
    values = spark.createDataFrame([(-5,), (0,), (59,), (60,), (61,), (None,)], "t bigint")
    ranges = spark.createDataFrame(
        [("all", None, None), ("neg", None, -1), ("mid", 0, 60), ("late", 61, None), ("no", 99, 98),
         ("far", 5000, 6000)],
        RANGES,
    )
    got = dict(rows(range_counts(values, "t", ranges)))
    assert got == {"all": 5, "neg": 1, "mid": 3, "late": 1, "no": 0, "far": 0}


def test_range_counts_without_values(spark):
    values = spark.createDataFrame([], "t bigint")
    ranges = spark.createDataFrame([("a", 0, 10), ("b", None, None)], RANGES)
    assert rows(range_counts(values, "t", ranges)) == [("a", 0), ("b", 0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.integers(-200, 200), max_size=30),
    ranges=st.lists(
        st.tuples(st.none() | st.integers(-200, 200), st.none() | st.integers(-200, 200)),
        min_size=1,
        max_size=6,
    ),
)
def test_range_counts_equal_brute_force(spark, values, ranges):
    table = [(f"r{i}", low, high) for i, (low, high) in enumerate(ranges)]
    got = dict(
        rows(
            range_counts(
                spark.createDataFrame([(v,) for v in values], "t bigint"),
                "t",
                spark.createDataFrame(table, RANGES),
                bin_width=7,
            )
        )
    )
    for name, low, high in table:
        inside = [
            v for v in values if (low is None or v >= low) and (high is None or v <= high)
        ]
        assert got[name] == len(inside)


def test_hash_split_is_complete_disjoint_and_stable(spark):
    df = spark.range(5_000)
    train, validation = hash_split(df, "id")
    a, b = {r[0] for r in train.collect()}, {r[0] for r in validation.collect()}
    assert not a & b and len(a | b) == 5_000
    assert 0.77 < len(a) / 5_000 < 0.83
    again, _ = hash_split(df.repartition(13).orderBy(F.desc("id")), "id")
    assert {r[0] for r in again.collect()} == a
    other, _ = hash_split(df, "id", salt="42-")
    assert {r[0] for r in other.collect()} != a
    parts = hash_split(df, "id", (1, 1, 2))
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 5_000
    named = df.groupBy(split_part("id", "abc", (1, 1, 2)).alias("part")).count()
    assert dict(rows(named)) == dict(zip("abc", sizes))


SETS = "t array<string>, p array<string>"


def test_positional_vectors_only_measure_how_many_are_set(spark):
    df = spark.createDataFrame([(["severe_toxic", "obscene"], ["toxic", "insult"])], SETS)
    got = document_scores(df, "t", "p").first()
    assert got["agreement_f1"] == 1.0
    assert got["f1"] == 0.0 and got["subset_accuracy"] == 0.0


def test_two_empty_sets_agree(spark):
    df = spark.createDataFrame([([], []), (None, None)], SETS)
    got = document_scores(df, "t", "p").first()
    assert got["documents"] == 2
    assert got["f1"] == got["precision"] == got["recall"] == got["accuracy"] == 1.0
    assert got["hamming_loss"] == 0.0


def sample(spark):
    sets = [
        (["toxic"], ["toxic"]),
        (["toxic", "insult"], ["toxic"]),
        (["threat"], ["insult", "obscene"]),
        (["obscene", "insult", "toxic"], ["insult", "toxic", "identity_hate"]),
        (["severe_toxic"], ["severe_toxic", "toxic"]),
    ]
    return spark.createDataFrame(sets, SETS)


def test_scores_equal_spark_evaluator(spark):
    df = sample(spark)
    ids = {label: float(i) for i, label in enumerate(LABELS)}
    lookup = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    as_ids = df.select(
        F.transform("t", lambda x: lookup[x]).alias("label"),
        F.transform("p", lambda x: lookup[x]).alias("prediction"),
    )

    def spark_metric(data, name, label=0.0):
        return MultilabelClassificationEvaluator(metricName=name, metricLabel=label).evaluate(data)

    got = document_scores(df, "t", "p").first()
    pairs = {
        "subsetAccuracy": "subset_accuracy",
        "accuracy": "accuracy",
        "precision": "precision",
        "recall": "recall",
        "f1Measure": "f1",
        "microPrecision": "micro_precision",
        "microRecall": "micro_recall",
        "microF1Measure": "micro_f1",
    }
    for theirs, ours in pairs.items():
        assert got[ours] == pytest.approx(spark_metric(as_ids, theirs)), theirs
    per_label = {r["label"]: r for r in label_scores(df, "t", "p").collect()}
    # Spark raises for a label that was never predicted rightly, so not all six.
    for label in ("toxic", "insult", "severe_toxic"):
        for theirs, ours in (
            ("precisionByLabel", "precision"),
            ("recallByLabel", "recall"),
            ("f1MeasureByLabel", "f1"),
        ):
            assert per_label[label][ours] == pytest.approx(spark_metric(as_ids, theirs, ids[label]))
    vectors = df.select(label_vector("t").alias("label"), label_vector("p").alias("prediction"))
    assert got["agreement_f1"] == pytest.approx(spark_metric(vectors, "f1Measure"))


def test_label_scores(spark):
    scores = {r["label"]: tuple(r)[1:] for r in label_scores(sample(spark), "t", "p").collect()}
    assert scores["toxic"][:3] == (3, 1, 0)
    assert scores["threat"] == (0, 0, 1, 0.0, 0.0, 0.0)
    mean = macro_f1(label_scores(sample(spark), "t", "p")).first()[0]
    assert mean == pytest.approx(sum(s[-1] for s in scores.values()) / 6)


def test_scores_of_no_rows(spark):
    empty = spark.createDataFrame([], SETS)
    assert document_scores(empty, "t", "p").first()["documents"] == 0
    assert {r["tp"] for r in label_scores(empty, "t", "p").collect()} == {0}


@pytest.mark.parametrize("values", [[0, 10**12], [1_700_000_000, 1_700_000_060], [5], []])
def test_range_counts_on_any_extent(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "t long")
    spans = [("all", None, None), ("wide", -(10**15), 10**15), ("low", None, 5), ("edge", 10**12, 10**13), ("none", 9, 3)]
    ranges = spark.createDataFrame(spans, "name string, low long, high long")
    want = {
        n: sum((a is None or v >= a) and (b is None or v <= b) for v in values) for n, a, b in spans
    }
    assert dict(rows(range_counts(df, "t", ranges))) == want
    assert dict(rows(range_counts(df, "t", ranges, bin_width=1, bins=3))) == want


def test_hash_split_keeps_rows_without_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("", 3), (None, 4)], "k string, v int")
    parts = hash_split(df, "k", (1, 1, 1))
    assert sorted(r["v"] for p in parts for r in p.collect()) == [1, 2, 3, 4]
    assert df.filter(split_part("k", ("x", "y")).isNull()).count() == 0


def test_more_conditions_than_bits_of_a_mask(spark):
    rows = spark.range(700).select((F.col("id") / 7).cast("int").alias("k"), (F.col("id") % 70).alias("x"))
    found = labelled_distinct_counts(rows, "k", {str(i): F.col("x") == i for i in range(70)} | {"none": F.lit(None).cast("boolean")}, "name", "n")
    assert {r["name"]: r["n"] for r in found.collect()} == {str(i): 10 for i in range(70)} | {"none": 0}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "bool_or" not in plan and "bit_or" in plan

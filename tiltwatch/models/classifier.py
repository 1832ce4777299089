"""A multi-label text classifier: one sparse logistic regression per label."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiltwatch.config import LABELS
from tiltwatch.models.text import (
    TEXT_FEATURES,
    document_stage,
    sentence_vector_stages,
    text_feature_stages,
    token_stage,
)

#: A pass of the solver has two tasks per core, or so many at least.
LEAST_TASKS = 24


def _probability(label: str) -> str:
    return f"probability_{label}"


def _without(*columns: str) -> Transformer:
    return SQLTransformer(statement=f"SELECT * EXCEPT ({', '.join(columns)}) FROM __THIS__")


class PlainVector(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Takes from a vector column the description of its entries.

    An assembled vector names each of its entries in the schema, which every
    job then carries along: with 65,536 of them a pass of the solver took five times as long.
    """

    inputCol = Param(Params._dummy(), "inputCol", "vector column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol: str = "features"):
        super().__init__()
        self._setDefault(inputCol="features")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withMetadata(self.getOrDefault(self.inputCol), {})


class LabelAssembler(
    Transformer, DefaultParamsReadable, DefaultParamsWritable
):
    """Folds the labels' probability vectors into ``class``.

    ``class`` is ``array<struct<result, confidence>>`` with the labels whose
    probability exceeds their threshold; ``class.result`` is the label set.
    ``thresholds``, one per label, goes before the common ``threshold``.
    """

    labels = Param(Params._dummy(), "labels", "label names", TypeConverters.toListString)
    threshold = Param(Params._dummy(), "threshold", "least probability", TypeConverters.toFloat)
    thresholds = Param(
        Params._dummy(), "thresholds", "least probability of each label", TypeConverters.toListFloat
    )

    @keyword_only
    def __init__(
        self, *, labels: Sequence[str] = LABELS, threshold: float = 0.7, thresholds: Sequence[float] = ()
    ):
        super().__init__()
        self._setDefault(labels=list(LABELS), threshold=0.7, thresholds=[])
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.getOrDefault(self.labels)
        least = dict.fromkeys(names, self.getOrDefault(self.threshold))
        least |= dict(zip(names, self.getOrDefault(self.thresholds)))
        scored = F.array(
            *[
                F.struct(
                    F.lit(name).alias("result"),
                    vector_to_array(_probability(name))[1].alias("confidence"),
                )
                for name in names
            ]
        )
        bounds = F.create_map(*[F.lit(x) for pair in least.items() for x in pair])
        kept = F.filter(scored, lambda item: item["confidence"] > bounds[item["result"]])
        return dataset.withColumn("class", kept).drop(*[_probability(n) for n in names])


class MultiLabelClassifier(Estimator):
    """Fits one L1 logistic regression per label on shared features.

    The features are materialised once, in partitions evened out by size since
    every iteration passes over them; the labels are then fitted side by side.
    Every fit is a distributed gradient sum over a vector of fixed width. Each
    task of a pass sends such a vector, so the partitions are read by a number of tasks that
    follows the cluster and not the input: what a pass moves does not grow with the rows. It
    ends after ``max_iter`` passes, or sooner where the loss changes by less
    than ``tolerance``; :func:`fit_report` tells which.
    """

    @keyword_only
    def __init__(
        self,
        *,
        labels: Sequence[str] = LABELS,
        label_col: str = "labels",
        features_col: str = "universal_embeddings",
        drop_features: bool = False,
        threshold: float = 0.7,
        thresholds: dict[str, float] | None = None,
        max_iter: int = 20,
        tolerance: float = 1e-6,
        penalty: float = 0.003,
        parallelism: int = 4,
    ):
        super().__init__()
        self.label_names = list(labels)
        self.label_col = label_col
        self.features_col = features_col
        self.drop_features = drop_features
        self.threshold = threshold
        self.thresholds = thresholds or {}
        self.max_iter = max_iter
        self.tolerance = tolerance
        self.penalty = penalty
        self.parallelism = parallelism

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        needed = dataset.select(self.features_col, self.label_col)
        shared = needed.hint("rebalance").persist(StorageLevel.MEMORY_AND_DISK)
        spark = dataset.sparkSession
        tasks = max(LEAST_TASKS, 2 * spark.sparkContext.defaultParallelism)

        def fit_label(label: str):
            learner = LogisticRegression(
                featuresCol=self.features_col,
                labelCol="target",
                probabilityCol=_probability(label),
                rawPredictionCol="",
                predictionCol="",
                maxIter=self.max_iter,
                tol=self.tolerance,
                regParam=self.penalty,
                elasticNetParam=1.0,
                family="binomial",
            )
            has_label = F.coalesce(F.array_contains(self.label_col, label), F.lit(False))
            target = has_label.cast("double").alias("target")
            return learner.fit(shared.select(self.features_col, target).coalesce(tasks))

        pool = ThreadPool(min(self.parallelism, len(self.label_names)))
        try:
            fitted = pool.map(inheritable_thread_target(spark)(fit_label), self.label_names)
        finally:
            pool.close()
            shared.unpersist()
        assembler = LabelAssembler(
            labels=self.label_names,
            threshold=self.threshold,
            thresholds=[float(self.thresholds.get(x, self.threshold)) for x in self.label_names],
        )
        last = [_without(self.features_col)] if self.drop_features else []
        return PipelineModel([*fitted, assembler, *last])


def fit_report(model: PipelineModel, max_iter: int) -> dict[str, float]:
    """``iterations_<label>`` and ``converged_<label>`` (1 or 0) of a freshly fitted pipeline."""
    report = {}
    for stage in model.stages[-1].stages:
        if isinstance(stage, LogisticRegressionModel) and stage.hasSummary:
            label = stage.getProbabilityCol().removeprefix(_probability(""))
            done = stage.summary.totalIterations
            report |= {f"iterations_{label}": float(done), f"converged_{label}": float(done < max_iter)}
    return report


def with_thresholds(model: PipelineModel, thresholds: dict[str, float]) -> PipelineModel:
    """The same fitted pipeline with other least probabilities; labels not named keep theirs."""

    def changed(stage):
        if isinstance(stage, PipelineModel):
            return PipelineModel([changed(s) for s in stage.stages])
        if not isinstance(stage, LabelAssembler):
            return stage
        names = stage.getOrDefault(stage.labels)
        common = stage.getOrDefault(stage.threshold)
        least = dict.fromkeys(names, common) | dict(zip(names, stage.getOrDefault(stage.thresholds))) | thresholds
        return LabelAssembler(labels=names, threshold=common, thresholds=[float(least[x]) for x in names])

    return changed(model)


def text_classifier(
    labels: Sequence[str] = LABELS,
    text_col: str = "comment_text",
    dimensions: int = 1 << 16,
    dense: bool = False,
    text_features: bool = False,
    **settings,
) -> Pipeline:
    """Document, tokens, sentence vector and classifier as one pipeline.

    ``text_features`` adds ``TEXT_FEATURES`` to the vector, for labels that
    depend on how a longer text is made rather than on its words.
    """
    stages = [document_stage(text_col), token_stage(), *sentence_vector_stages(dimensions, dense)]
    if text_features:
        given = ["universal_embeddings", *TEXT_FEATURES]
        stages += [
            *text_feature_stages(),
            VectorAssembler(inputCols=given, outputCol="features"),
            PlainVector(inputCol="features"),
            _without(*TEXT_FEATURES),
        ]
        settings = {"features_col": "features", "drop_features": True} | settings
    return Pipeline(stages=[*stages, MultiLabelClassifier(labels=list(labels), **settings)])

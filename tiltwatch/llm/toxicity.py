"""Toxicity by gradient-boosted trees over dense text features."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiltwatch.llm.common import drawn, keep, learnable

# Insults and slights, and words that address somebody.
LEXICON = frozenset(
    """idiot idiots idiotic moron morons moronic stupid stupidity dumb dumbass fool fools foolish loser losers
    clown clowns scum trash garbage filth filthy pathetic worthless disgusting useless hate hateful ugly vile
    vermin imbecile cretin jerk jackass bastard pig pigs freak freaks coward cowards liar liars hypocrite
    braindead retard retarded psycho creep creeps crap damn shit shitty fuck fucking bitch asshole whore slut
    dummkopf trottel vollidiot arschloch scheisse abschaum miststück idiota estúpido estúpida imbécil basura
    asqueroso mierda escoria patético inútil connard salaud crétin ordure imbécile pathétique ignoble merde
    débile nul""".split()
)
SECOND_PERSON = frozenset(
    """you your yours yourself youre u ur ya thou du dich dir dein deine euch ihr tu te toi ton ta tes vous votre
    vos tú ti usted ustedes vosotros su""".split()
)
#: Words to either side in which an insult counts as near somebody addressed.
NEAR = 5

FEATURES = (
    "log_words", "hits", "hit_rate", "has_hit", "distinct_hits", "hit_share_near_you", "you_rate",
    "masked_hits", "masked_rate", "spaced_hits", "capital_rate", "capital_word_rate", "mark_rate",
    "punctuation_rate", "digit_rate", "stretch_rate", "densest",
    "learned_hits", "learned_rate", "learned_distinct", "learned_most", "learned_sum",
)

_BYTES = bytes(range(256))
#: Everything in ASCII but letters and digits parts words.
_PART = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in _BYTES)
# Signs written for letters.
_UNMASK = bytes.maketrans(b"013457@$!+", b"oieastasit")
_LETTERS = np.array([chr(c).isalpha() and c < 128 for c in _BYTES])
_UPPER = np.array([65 <= c <= 90 for c in _BYTES])
_SIGNS = np.array([c < 128 and c > 32 and not chr(c).isalnum() for c in _BYTES])
_LEX = frozenset(w.encode() for w in LEXICON)
_YOU = frozenset(w.encode() for w in SECOND_PERSON)
_BY_LENGTH: dict[int, list[bytes]] = {}
for _w in sorted(_LEX):
    _BY_LENGTH.setdefault(len(_w), []).append(_w)


def _masked(token: bytes) -> bool:
    """Whether a token with signs in it stands for a word of the lexicon."""
    core = token.strip(b".,;:!?\"'()[]{}<>|#&%*")
    if core.isalpha() or len(core) < 3:
        return False
    if core.translate(_UNMASK) in _LEX or core.translate(None, b"._-*~'") in _LEX:
        return True
    if b"*" in core and core[0] != 42:
        return any(all(a == b or a == 42 for a, b in zip(core, w)) for w in _BY_LENGTH.get(len(core), ()))
    return False


def _terms(word: bytes) -> list[bytes]:
    """What the learned lexicon may list of a word: its beginnings, and the whole, marked by a space."""
    return [word[:k] for k in range(4, min(10, len(word)))] + [word + b" "]


def _words(text: str | None) -> list[bytes]:
    low = (text or "").lower().encode("utf-8", "surrogatepass")
    return low.translate(_PART).split()


def text_features(text: str | None, learned: dict[bytes, float], known: dict[bytes, float]) -> list[float]:
    """The :data:`FEATURES` of one whole text; all zero for NULL and blank texts.

    ``learned`` weighs terms; ``known`` remembers the weights of words met.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    low = raw.lower()
    words = _words(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    for w in set(words):
        if w not in known:
            known[w] = max((learned[t] for t in _terms(w) if t in learned), default=0.0)
    weights = [known[w] for w in words]
    marked = [i for i, x in enumerate(weights) if x]
    hits = np.array([i for i, w in enumerate(words) if w in _LEX], dtype=np.int64)
    you = np.array([i for i, w in enumerate(words) if w in _YOU], dtype=np.int64)
    near = 0
    if len(hits) and len(you):
        near = int((np.searchsorted(you, hits - NEAR) < np.searchsorted(you, hits + NEAR, side="right")).sum())
    densest = 0
    if len(hits):
        densest = int((np.searchsorted(hits, hits + 50) - np.arange(len(hits))).max())
    masked = sum(map(_masked, (w for w in low.split() if not w.isalpha())))
    # Letters spelled out one by one: the run so far ends in a word of the lexicon.
    spaced, run = 0, b""
    for i in [i for i, w in enumerate(words) if len(w) == 1] if n > 3 else ():
        run = (run + words[i])[-9:] if i and len(words[i - 1]) == 1 else words[i]
        spaced += any(run[-k:] in _LEX for k in range(4, len(run) + 1))
    codes = np.frombuffer(raw, dtype=np.uint8)
    counts = np.bincount(codes, minlength=256)
    letters = max(1, int(counts[_LETTERS].sum()))
    same = (codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2])
    return [
        float(np.log1p(n)), float(len(hits)), 1000.0 * len(hits) / n, float(len(hits) > 0),
        float(len({words[i] for i in hits})), near / max(1, len(hits)), 100.0 * len(you) / n,
        float(masked), 1000.0 * masked / n, float(spaced), float(counts[_UPPER].sum()) / letters,
        sum(map(bytes.isupper, raw.split())) / n, 100.0 * float(counts[33] + counts[63]) / n,
        100.0 * float(counts[_SIGNS].sum()) / n, 100.0 * float(counts[48:58].sum()) / n,
        100.0 * float((same & _LETTERS[codes[2:]]).sum()) / n, float(densest),
        float(len(marked)), 1000.0 * len(marked) / n, float(len({words[i] for i in marked})),
        max(weights), sum(weights),
    ]


def featured(
    docs: DataFrame, learned: dict[bytes, float], id_col: str = "doc_id", text_col: str = "text",
    others: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, one double per feature and the columns ``others`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[bytes, float] = {}
            found = np.array([text_features(t.as_py(), learned, known) for t in batch.column(1)])
            found = found.reshape(-1, len(FEATURES))
            columns = [pa.array(found[:, i]) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, *batch.columns[2:]], ["doc_id", *FEATURES, *others]
            )

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *others)
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("doc_id", *others)}
    kinds = {"doc_id": kinds["doc_id"]} | dict.fromkeys(FEATURES, "double") | kinds
    return rows.mapInArrow(run, ", ".join(f"{c} {kind}" for c, kind in kinds.items()))


@dataclass
class ToxicityModel:
    """The trees, and the calibration of their output to a probability."""

    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    rate: float

    def score(self, features: DataFrame) -> DataFrame:
        """``features`` with ``score``; computed in the JVM, row by row."""
        if self.trees is None:
            return features.withColumn("score", F.lit(self.rate))
        rows = VectorAssembler(inputCols=list(FEATURES), outputCol="__vector").transform(features)
        rows = _raw(self.trees, rows)
        if self.calibration is not None:
            rows = self.calibration.transform(rows)
        else:
            rows = rows.withColumn("__calibrated", F.col("__raw"))
        score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("__calibrated")))
        return rows.withColumn("score", score).drop("__vector", "__raw", "__calibrated")


def _raw(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    out = trees.transform(rows).withColumn("__raw", vector_to_array("probability")[1])
    return out.drop("rawPrediction", "probability", "prediction")


def sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit_rows: int, seed: int
) -> tuple[DataFrame | None, float]:
    """At most ``fit_rows`` labelled rows that are not held out, and the share of label 1 among all such.

    ``doc_id, text, label, part``, drawn by a hash of the id and written once.
    Of several labels of an id the highest counts, of several rows the text
    with the least hash. None without both labels.
    """
    marks = (
        labels.filter(learnable(F.col(id_col)) & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("double").alias("label"))
    )
    total, ones = marks.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if not total or ones in (0, total):
        return None, ones / total if total else 0.0
    # Ids first, a fifth more than wanted by hash, so that neither all ids nor any text is sorted.
    enough = drawn(f"fit-{seed}", F.col("doc_id"), 1.2 * fit_rows / total)
    ids = keep(
        marks.filter(enough).orderBy(F.xxhash64(F.lit(f"fit-{seed}"), "doc_id"), "doc_id").limit(fit_rows),
        "toxicity-ids",
    )
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).filter(enough)
    # Rows of an id are told apart by their text alone; tasks find the least hash before anything moves.
    rows = rows.join(ids, "doc_id").groupBy("doc_id", "label").agg(
        F.min_by("text", F.struct(F.xxhash64(F.coalesce("text", F.lit(""))), "text")).alias("text")
    )
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(f"part-{seed}"), "doc_id"), F.lit(4)))
    return keep(rows.repartition(8).sortWithinPartitions("doc_id"), "toxicity-rows"), ones / total


def learn_terms(rows: DataFrame, terms: int = 400, least: int = 8, odds: float = 3.0) -> dict[bytes, float]:
    """Log-odds of the words and beginnings of words that speak for label 1.

    Documents are counted, tasks first; a term needs ``least`` documents of
    label 1 and log-odds of ``odds``; the ``terms`` most frequent ones remain.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, list[int]] = {}
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist()):
                for term in {t for w in set(_words(text.as_py())) for t in _terms(w)}:
                    seen.setdefault(term, [0, 0])[int(label > 0)] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), *(pa.array([x[i] for x in seen.values()], pa.int64()) for i in (0, 1))],
            ["term", "zeros", "ones"],
        )

    zeros, ones = rows.agg(F.sum(1 - F.col("label")), F.sum("label")).first()
    if not zeros or not ones:
        return {}
    score = F.log((F.col("ones") + 0.5) / (ones + 1)) - F.log((F.col("zeros") + 0.5) / (zeros + 1))
    found = (
        rows.select("text", "label").mapInArrow(count, "term binary, zeros long, ones long")
        .groupBy("term").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
        .filter(F.col("ones") >= least)
        .withColumn("score", score).filter(F.col("score") >= odds)
        .orderBy(F.desc("ones"), "term").limit(terms)
    )
    return {bytes(r["term"]): r["score"] for r in found.collect()}  # `terms` rows at most


def fit(
    rows: DataFrame | None, learned: dict[bytes, float], rate: float, trees: int, depth: int, seed: int
) -> ToxicityModel:
    """Trees from three quarters of the drawn rows, calibrated on the rest, which they have not seen.

    With labels of one kind, or none, the score is the share of label 1.
    """
    if rows is None:
        return ToxicityModel(None, None, rate)
    marked = featured(rows, learned, others=("label", "part"))
    marked = keep(marked.repartition(4).sortWithinPartitions("doc_id"), "toxicity-features")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="__vector").transform(marked)
    grow, rest = vectors.filter("part != 0"), vectors.filter("part = 0")
    if grow.select("label").distinct().count() < 2:
        return ToxicityModel(None, None, rate)
    grow = grow.persist()
    try:
        model = GBTClassifier(
            featuresCol="__vector", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2,
            minInstancesPerNode=5, seed=seed,
        ).fit(grow)
    finally:
        grow.unpersist()
    calibration = None
    if rest.select("label").distinct().count() == 2:
        calibration = IsotonicRegression(
            featuresCol="__raw", labelCol="label", predictionCol="__calibrated"
        ).fit(_raw(model, rest))
    return ToxicityModel(model, calibration, rate)


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    fit_rows: int = 12_000, trees: int = 20, depth: int = 4, seed: int = 0,
) -> DataFrame:
    """``doc_id``, the features and ``score`` (0 to 1) for every row of ``docs``.

    Features are read off the whole text: densities of insults, from a fixed
    list and from terms learned on the labelled rows, how near they stand to
    somebody addressed, capitals, punctuation, and masked, spaced or stretched
    spellings. Terms, trees and calibration are learned from at most
    ``fit_rows`` labelled ids that are not held out, one row each; a quarter
    of them serves calibration only.

    NULL and blank texts have zero features and are scored like any other.
    Repeated rows each get a row; NULL ids are scored but not learned from.
    Other columns are not read; an empty table gives an empty result.
    """
    rows, rate = sample(docs, labels, id_col, text_col, label_col, fit_rows, seed)
    learned = {} if rows is None else learn_terms(rows.filter("part != 0"))
    model = fit(rows, learned, rate, trees, depth, seed)
    return model.score(featured(docs, learned, id_col, text_col))

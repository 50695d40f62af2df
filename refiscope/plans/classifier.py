"""Boosted-tree distress classifier trained and scored on executors."""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators import boosting, encode, metrics
from ..operators.boosting import BoostedModel, Params
from ..session import constant_table, release, stage
from .frame import SparseFrame, TrainingFrame


def random_params(n: int, seed: int = 42, max_trees: int = 500) -> list[Params]:
    """Seeded draws from the search ranges (learning rate and penalties on a log scale)."""
    rng = random.Random(seed)
    return [
        Params(
            max_depth=rng.randint(*C.SEARCH_RANGES["max_depth"]),
            learning_rate=math.exp(rng.uniform(*map(math.log, C.SEARCH_RANGES["learning_rate"]))),
            n_trees=rng.randint(min(C.SEARCH_RANGES["n_trees"][0], max_trees), min(C.SEARCH_RANGES["n_trees"][1], max_trees)),
            min_child_weight=rng.randint(*C.SEARCH_RANGES["min_child_weight"]),
            subsample=rng.uniform(*C.SEARCH_RANGES["subsample"]),
            feature_share=rng.uniform(*C.SEARCH_RANGES["feature_share"]),
            reg_alpha=math.exp(rng.uniform(*map(math.log, C.SEARCH_RANGES["reg_alpha"]))),
            reg_lambda=math.exp(rng.uniform(*map(math.log, C.SEARCH_RANGES["reg_lambda"]))),
        )
        for _ in range(n)
    ]


def vectorized(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep").transform(rows)


def weighted(rows: DataFrame, label: str = C.LABEL, balanced: DataFrame | None = None) -> DataFrame:
    """Row weight: negatives / positives of the train rows for a positive, else 1."""
    balance = encode.class_balance(rows if balanced is None else balanced, label).select("scale_pos_weight")
    return rows.crossJoin(F.broadcast(balance)).withColumn(  # one-row side
        "weight", F.when(F.col(label) == 1, F.col("scale_pos_weight")).otherwise(1.0)
    ).drop("scale_pos_weight")


def fit(train: DataFrame, params: Params, label: str = C.LABEL, seed: int = 42) -> GBTClassificationModel:
    """One model by the session's own tree learner, on rows with ``features`` and ``weight`` columns."""
    return GBTClassifier(
        featuresCol="features", labelCol=label, weightCol="weight", maxDepth=params.max_depth, maxIter=params.n_trees,
        stepSize=params.learning_rate, minInstancesPerNode=max(1, round(params.min_child_weight)), subsamplingRate=params.subsample,
        featureSubsetStrategy=str(params.feature_share), seed=seed,
    ).fit(train)


@dataclass(frozen=True)
class SearchResult:
    trials: DataFrame  # one row per trial
    best: Params
    model: BoostedModel


TRIAL_DDL = ("trial int, max_depth int, learning_rate double, n_trees int, min_child_weight double, subsample double, feature_share double, "
             "reg_alpha double, reg_lambda double, grown int, best_trees int, valid_auc double, ended string, chosen boolean")


def search(tf: TrainingFrame | SparseFrame, trials: Sequence[Params], label: str = C.LABEL, seed: int = 42, stopping: boosting.Stopping = boosting.Stopping()) -> SearchResult:
    """All trials grown side by side; the one with the best validation ROC area (ties: the earlier) is the model.
    Of a sparse frame the categories are cut by their codes, and the model names those it asks for."""
    if not trials:
        raise ValueError("a search needs at least one trial")
    sparse = isinstance(tf, SparseFrame)
    numbers, codes, vocab = (tf.numeric, tf.codes, tf.vocabulary) if sparse else (tf.features, [], None)
    rows = weighted(tf.rows.where("split in ('train', 'valid')"), label, tf.rows)
    rows = stage(rows.select("loan_id", "split", label, "weight", *[F.col(f"`{c}`") for c in [*numbers, *codes]]), "search-rows")
    grown, edges = boosting.fit_trials(rows, numbers, trials, label, seed=seed, stopping=stopping, codes=codes)
    area = lambda t: max(t.areas) if t.areas else float("-inf")
    best = max(grown, key=lambda t: (area(t), -t.number))
    log = []
    for t in grown:
        p = t.params
        log.append((t.number, p.max_depth, float(p.learning_rate), p.n_trees, float(p.min_child_weight), float(p.subsample), float(p.feature_share),
                    float(p.reg_alpha), float(p.reg_lambda), len(t.trees), t.best(), area(t) if t.areas else None, t.why, t is best))
    release(rows)
    return SearchResult(constant_table(tf.rows.sparkSession, log, TRIAL_DDL), best.params, boosting.model_of(best, numbers, edges, codes, vocab))


def score(model: GBTClassificationModel | BoostedModel, rows: DataFrame, features: Sequence[str] = (), out: str = "pd") -> DataFrame:
    """Add the positive-class probability; vectors exist only inside the stage. A boosted model reads the
    columns that it names, absent ones as 0; ``features`` is for the session's own tree learner."""
    if isinstance(model, BoostedModel):
        return rows.withColumn(out, boosting.probability(model, rows.columns))
    scored = model.transform(vectorized(rows, features))
    return scored.withColumn(out, vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def evaluate(model: GBTClassificationModel | BoostedModel, tf: TrainingFrame | SparseFrame, split: str = "test", label: str = C.LABEL) -> DataFrame:
    features = () if isinstance(tf, SparseFrame) else tf.features
    scored = stage(score(model, tf.rows.where(F.col("split") == split), features).select(label, "pd"), "scored")
    return metrics.classification_metrics(scored, "pd", label)


def importances(model: GBTClassificationModel | BoostedModel, tf: TrainingFrame | None = None, k: int = 20) -> DataFrame:
    """The ``k`` features with the largest share in the gain of all cuts."""
    boosted = isinstance(model, BoostedModel)
    names, values = (model.features, model.importances()) if boosted else (tf.features, model.featureImportances.toArray())
    table = constant_table(SparkSession.active(), [(f, float(v)) for f, v in zip(names, values, strict=True)], "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)


def portfolio_scorer(model: BoostedModel, tf: TrainingFrame | SparseFrame):
    """Scorer for stress runs: encodes the metro as in training, then scores; the model itself knows which
    categories it asks for, so no list of them and no join is needed."""
    def scorer(df: DataFrame) -> DataFrame:
        keep = df.columns
        encoded = encode.encode_target(df, "metro_area", tf.metro_means, tf.global_mean, "metro_encoded")
        return score(model, encoded).select(*keep, "pd")

    return scorer


def save(spark: SparkSession, model: BoostedModel, path: str) -> None:
    """The model as one line of JSON in a folder any executor can reach."""
    constant_table(spark, [(model.to_json(),)], "value string").write.mode("overwrite").text(path)


def load(spark: SparkSession, path: str) -> BoostedModel:
    return BoostedModel.from_json(spark.read.text(path, wholetext=True).first()["value"])

"""Boosted trees on balanced training rows, and probability calibration."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tierwise.functions.fixed_values import BOOSTING_DEFAULTS
from tierwise.functions.lineage import checkpointed
from tierwise.operators.isotonic import isotonic_blocks, predict_isotonic
from tierwise.operators.preprocessing import build_preprocessor
from tierwise.operators.resampling import resample, strategy_name


def boosting_params(given: dict | None = None) -> dict:
    """Defaults overridden by the given settings; unknown names are an error."""
    unknown = set(given or {}) - set(BOOSTING_DEFAULTS)
    if unknown:
        raise ValueError(f"unknown boosting settings: {sorted(unknown)}")
    params = {**BOOSTING_DEFAULTS, **(given or {})}
    if params["reg_alpha"] or params["reg_lambda"] != BOOSTING_DEFAULTS["reg_lambda"]:
        warnings.warn("reg_alpha and reg_lambda have no counterpart in Spark ML trees and are ignored", stacklevel=2)
    return params


def build_classifier(params: dict | None, seed: int, total_weight: float = 1.0) -> GBTClassifier:
    """Spark ML trees from the usual names; ``gamma`` is a summed loss, so it is spread over rows."""
    p = boosting_params(params)
    return GBTClassifier(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        maxIter=int(p["n_estimators"]),
        maxDepth=int(p["max_depth"]),
        stepSize=float(p["learning_rate"]),
        minInstancesPerNode=max(1, round(p["min_child_weight"])),
        subsamplingRate=float(p["subsample"]),
        featureSubsetStrategy=str(float(p["colsample_bytree"])),
        minInfoGain=float(p["gamma"]) / max(total_weight, 1.0),
        seed=seed,
    )


def fit_boosted(rows: DataFrame, params: dict | None = None, seed: int = 42):
    """Fit on ``(label, vector)``; positives weigh ``scale_pos_weight``."""
    weight = float(boosting_params(params)["scale_pos_weight"])
    positive = F.col("label") == 1
    total = rows.agg(F.sum(F.when(positive, F.lit(weight)).otherwise(1.0))).first()[0] or 1.0
    ready = rows.select(
        array_to_vector(F.col("vector").cast("array<double>")).alias("features"),
        F.col("label").cast("double").alias("label"),
        F.when(positive, F.lit(weight)).otherwise(F.lit(1.0)).alias("weight"),
    )
    return build_classifier(params, seed, total).fit(ready)


@dataclass
class TrainSpec:
    """Everything a fit depends on, apart from its rows."""

    target: str
    key: str
    numeric: Sequence[str]
    categorical: Sequence[str]
    params: dict = field(default_factory=dict)
    strategy: str = "borderline_smote"
    sampler: dict = field(default_factory=dict)
    clip_lower: float = 0.01
    clip_upper: float = 0.99
    numeric_rounds: int = 20
    categorical_rounds: int = 10
    categorical_trees: int = 50
    seed: int = 42

    def preprocessor(self) -> Pipeline:
        return build_preprocessor(
            self.numeric,
            self.categorical,
            self.clip_lower,
            self.clip_upper,
            self.numeric_rounds,
            self.categorical_rounds,
            self.categorical_trees,
            seed=self.seed,
        )


def to_vectors(prepared: DataFrame, target: str, key: str) -> DataFrame:
    """``(key, label, vector)`` rows for the resampling operators."""
    return prepared.select(
        F.col(key).alias("key"),
        F.col(target).cast("int").alias("label"),
        vector_to_array("features").alias("vector"),
    )


class RiskEstimator(Estimator):
    """Preprocess, rebalance the training rows, fit the trees.

    The fitted model holds preprocessing and trees only: rebalancing is part of ``fit`` and
    never touches rows being scored.
    """

    def __init__(self, spec: TrainSpec):
        super().__init__()
        self.spec = spec

    def _fit(self, train: DataFrame) -> PipelineModel:
        spec = self.spec
        strategy = strategy_name(spec.strategy)
        prepare = spec.preprocessor().fit(train)
        rows = checkpointed(to_vectors(prepare.transform(train), spec.target, spec.key))
        balanced = resample(rows, strategy, spec.seed, **spec.sampler)
        if strategy != "none":
            balanced = checkpointed(balanced)  # the trees pass over it many times
        model = fit_boosted(balanced, spec.params, spec.seed)
        return PipelineModel(stages=[prepare, model])


def positive_probability(column: str = "probability") -> Column:
    return F.get(vector_to_array(column), F.lit(1))


def score(model: PipelineModel, rows: DataFrame, key: str, target: str | None = None) -> DataFrame:
    """``(key, [y,] p)`` of every row."""
    label = [F.col(target).cast("int").alias("y")] if target else []
    keep = rows.withColumn("_key", F.col(key))
    if target:
        keep = keep.withColumn("_y", F.col(target))
        label = [F.col("_y").cast("int").alias("y")]
    return model.transform(keep).select(F.col("_key").alias("key"), *label, positive_probability().alias("p"))


# ---------------------------------------------------------------- calibration


def by_score(held_out: DataFrame) -> DataFrame:
    """One row per distinct score; both calibrations depend on nothing finer."""
    return held_out.groupBy(F.col("p").cast("double").alias("p")).agg(
        F.sum(F.col("y").cast("double")).alias("pos"), F.count(F.lit(1)).cast("double").alias("n")
    )


def calibrate_isotonic(held_out: DataFrame, scored: DataFrame) -> DataFrame:
    """Monotone calibration learned on held-out scores; adds ``calibrated``."""
    return predict_isotonic(scored, isotonic_blocks(by_score(held_out)))


def calibrate_sigmoid(held_out: DataFrame, scored: DataFrame) -> DataFrame:
    """Logistic calibration with Platt's smoothed targets; adds ``calibrated``."""
    points = by_score(held_out)
    sizes = points.agg(F.sum("pos").alias("pos"), F.sum(F.col("n") - F.col("pos")).alias("neg")).first()
    high = (sizes["pos"] + 1.0) / (sizes["pos"] + 2.0)
    low = 1.0 / (sizes["neg"] + 2.0)
    toward_one = F.col("pos") * high + (F.col("n") - F.col("pos")) * low
    sides = points.select(
        "p",
        F.explode(
            F.array(
                F.struct(F.lit(1.0).alias("label"), toward_one.alias("weight")),
                F.struct(F.lit(0.0).alias("label"), (F.col("n") - toward_one).alias("weight")),
            )
        ).alias("s"),
    ).select("p", "s.label", "s.weight")
    assemble = VectorAssembler(inputCols=["p"], outputCol="_score")
    learner = LogisticRegression(
        featuresCol="_score", labelCol="label", weightCol="weight", probabilityCol="_prob",
        rawPredictionCol="_raw", predictionCol="_pred", maxIter=200, tol=1e-9,
    )
    model = learner.fit(assemble.transform(sides))
    out = model.transform(assemble.transform(scored))
    return out.withColumn("calibrated", positive_probability("_prob")).drop("_score", "_prob", "_raw", "_pred")

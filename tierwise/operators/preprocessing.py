"""From raw columns to a feature vector: numeric branch first, then categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler

from tierwise.operators.cleaning import OrdinalEncoder, QuantileClipper
from tierwise.operators.imputation import ChainedCategoryImputer, ChainedLinearImputer


def build_preprocessor(
    numeric: Sequence[str],
    categorical: Sequence[str],
    clip_lower: float = 0.01,
    clip_upper: float = 0.99,
    numeric_rounds: int = 20,
    categorical_rounds: int = 10,
    categorical_trees: int = 50,
    solver: str = "bayesian",
    seed: int = 42,
) -> Pipeline:
    """Clip and impute numbers, impute and encode categories, assemble ``features``."""
    numeric, categorical = list(numeric), list(categorical)
    stages = []
    if numeric:
        stages += [
            QuantileClipper(inputCols=numeric, lower=clip_lower, upper=clip_upper),
            ChainedLinearImputer(inputCols=numeric, maxIter=numeric_rounds, solver=solver),
        ]
    if categorical:
        stages += [
            ChainedCategoryImputer(
                inputCols=categorical,
                maxIter=categorical_rounds,
                numTrees=categorical_trees,
                seed=seed,
            ),
            OrdinalEncoder(inputCols=categorical),
        ]
    stages.append(VectorAssembler(inputCols=[*numeric, *categorical], outputCol="features"))
    return Pipeline(stages=stages)


def feature_names(model: PipelineModel) -> list[str]:
    """Names in vector order, read from the assembling stage."""
    stages = [s for s in _flat(model) if isinstance(s, VectorAssembler)]
    return stages[-1].getInputCols()


def _flat(model: PipelineModel):
    for stage in model.stages:
        if isinstance(stage, PipelineModel):
            yield from _flat(stage)
        else:
            yield stage

"""Cross-validation and parameter search."""

from __future__ import annotations

import statistics
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from functools import reduce
from threading import Lock

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.functions.fixed_values import ALLKNN_SEARCH_SPACE, NCR_SEARCH_SPACE, TREE_SEARCH_SPACE
from tierwise.functions.hashing import draw_unit
from tierwise.functions.lineage import checkpointed
from tierwise.operators.boosting import (
    RiskEstimator,
    TrainSpec,
    fit_boosted,
    positive_probability,
    score,
    to_vectors,
)
from tierwise.operators.metrics import classification_metrics, objective_score
from tierwise.operators.resampling import borderline_smote, clean_resampled, strategy_name
from tierwise.operators.split import stratified_folds

CV_METRICS = ("pr_auc", "roc_auc", "recall", "precision", "f1", "f2", "specificity", "brier")


def baseline_cv(
    train: DataFrame, spec: TrainSpec, n_splits: int, threshold: float, parallelism: int = 1
) -> DataFrame:
    """Metric row per fold.  ``parallelism`` folds are fitted at a time, all are measured together."""
    folds = checkpointed(stratified_folds(train, spec.target, spec.key, n_splits, spec.seed, "_fold"))

    def held_out(fold: int) -> DataFrame:
        model = RiskEstimator(spec).fit(folds.where(F.col("_fold") != fold).drop("_fold"))
        held = folds.where(F.col("_fold") == fold).drop("_fold")
        return score(model, held, spec.key, spec.target).withColumn("fold", F.lit(fold + 1))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        parts = list(pool.map(held_out, range(n_splits)))
    scored = reduce(DataFrame.unionByName, parts)
    return classification_metrics(checkpointed(scored), threshold, ["fold"])


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and population deviation of each metric over the folds."""
    wide = folds.agg(
        *[F.avg(m).alias(f"mean_{m}") for m in CV_METRICS],
        *[F.stddev_pop(m).alias(f"std_{m}") for m in CV_METRICS],
    )
    cells = [
        F.struct(F.lit(m).alias("metric"), F.col(f"mean_{m}").alias("mean"), F.col(f"std_{m}").alias("std"))
        for m in CV_METRICS
    ]
    return wide.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")


# ---------------------------------------------------------------- trials


def _draw(trial: Column, seed: int, name: str, kind: str, low, high) -> Column:
    u = draw_unit(trial, seed, name)
    if kind == "choice":
        return F.when(u < 0.5, F.lit(low)).otherwise(F.lit(high))
    if kind == "int":
        return (F.lit(low) + F.floor(u * F.lit(high - low + 1))).cast("int")
    if kind == "log":
        bottom, top = F.ln(F.lit(float(low))), F.ln(F.lit(float(high)))
        return F.exp(bottom + u * (top - bottom))
    return F.lit(float(low)) + u * F.lit(float(high) - float(low))


def sampler_space(strategy: str) -> list[tuple]:
    name = strategy_name(strategy)
    return {"borderline_smote_allknn": ALLKNN_SEARCH_SPACE, "borderline_smote_ncr": NCR_SEARCH_SPACE}.get(name, [])


def search_trials(
    trials: DataFrame, strategy: str, seed: int = 42, trial: str = "trial", limits: dict | None = None
) -> DataFrame:
    """Draw the settings of every trial; model and sampler settings stay apart.

    ``limits`` replaces drawn model settings.
    """
    at = F.col(trial)
    drawn = {n: _draw(at, seed, n, kind, lo, hi) for n, kind, lo, hi in TREE_SEARCH_SPACE}
    drawn |= {n: F.lit(v) for n, v in (limits or {}).items()}
    model = F.struct(*[v.alias(n) for n, v in drawn.items()])
    space = sampler_space(strategy)
    out = trials.select(at.alias("trial"), model.alias("model"))
    if space:
        sampler = F.struct(*[_draw(at, seed, n, kind, lo, hi).alias(n) for n, kind, lo, hi in space])
        out = out.withColumn("sampler", sampler)
    return out


def median_prune(scores: DataFrame, warmup: int = 2, startup: int = 5, block: int = 1) -> DataFrame:
    """Pruning decision for every recorded ``(trial, step, running_mean)``.

    A trial is stopped after the warm-up when its running mean lies below the median of at
    least ``startup`` trials of earlier blocks that reached the same step.  Blocks are
    ``block`` consecutive trials; those of one block do not see each other.
    """
    number = F.floor(F.col("trial") / F.lit(block))
    earlier = Window.partitionBy("step").orderBy(number).rangeBetween(Window.unboundedPreceding, -1)
    seen = F.count("running_mean").over(earlier)
    median = F.percentile("running_mean", 0.5).over(earlier)
    cut = (F.col("step") > warmup) & (seen >= startup) & (F.col("running_mean") < median)
    return scores.select(
        "trial", "step", "running_mean", median.alias("median_before"), F.coalesce(cut, F.lit(False)).alias("prune")
    )


def running_means(fold_scores: DataFrame) -> DataFrame:
    upto = Window.partitionBy("trial").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    return fold_scores.withColumn("running_mean", F.avg("score").over(upto))


def best_trial(results: DataFrame) -> DataFrame:
    """Best complete trial (the first among equals) and the number of trials."""
    done = F.col("state") == "complete"
    pick = F.max_by(
        F.struct("trial", "value"), F.when(done, F.struct("value", (-F.col("trial")).alias("_first")))
    )
    return results.agg(pick.alias("_b"), F.count(F.lit(1)).alias("n_trials")).select(
        F.col("_b.trial").alias("best_trial"), F.col("_b.value").alias("best_value"), "n_trials"
    )


@dataclass
class SearchResult:
    trials: DataFrame  # trial, model, sampler, value, state
    steps: DataFrame  # trial, step, score
    best_params: dict = field(default_factory=dict)
    best_sampler: dict = field(default_factory=dict)
    best_value: float | None = None


@dataclass
class _Fold:
    grown: DataFrame
    valid: DataFrame
    cleaned: dict = field(default_factory=dict)
    guards: dict = field(default_factory=dict)


def random_search(
    train: DataFrame,
    spec: TrainSpec,
    n_splits: int,
    n_trials: int,
    objective: str,
    threshold: float = 0.5,
    top_pct: float = 0.5,
    pr_auc_weight: float = 0.4,
    timeout_seconds: float | None = None,
    parallelism: int = 1,
    warmup: int = 2,
    startup: int = 5,
    limits: dict | None = None,
    block: int = 5,
) -> SearchResult:
    """Random search over trees and cleaner, with median pruning between folds.

    No searched setting touches preprocessing or oversampling, so both are done once per
    fold and kept; a trial only cleans, fits and scores.  ``limits`` overrides drawn
    settings, e.g. to bound the number of trees.  Trials run in blocks of ``block``, up to
    ``parallelism`` at a time, and are pruned by the rule of ``median_prune`` against earlier
    blocks: the result does not depend on which trial of a block ends first.
    """
    spark = train.sparkSession
    drawn = [r.asDict(recursive=True) for r in search_trials(
        spark.range(n_trials).withColumnRenamed("id", "trial"), spec.strategy, spec.seed, limits=limits
    ).orderBy("trial").collect()]  # n_trials rows
    folds = _prepare_folds(train, spec, n_splits, parallelism)
    history: dict[int, list[float]] = {}
    states: dict[int, str] = {}
    lock, begun = Lock(), time.monotonic()

    def run(row: dict) -> None:
        trial = row["trial"]
        if timeout_seconds is not None and time.monotonic() - begun > timeout_seconds:
            return
        sampler = row.get("sampler") or {}
        others = {t: m for t, m in list(history.items()) if t // block < trial // block}
        scores: list[float] = []
        for step, fold in enumerate(folds, start=1):
            rows = _cleaned(fold, spec.strategy, sampler, lock)
            model = fit_boosted(rows, row["model"], spec.seed)
            ready = fold.valid.withColumn("features", array_to_vector("vector"))
            scored = model.transform(ready).select(
                "key", F.col("label").alias("y"), positive_probability().alias("p")
            ).persist()  # an objective reads the scores more than once
            value = objective_score(scored, objective, threshold, top_pct, pr_auc_weight).first()["score"]
            scored.unpersist()
            scores.append(float(value if value is not None else 0.0))
            with lock:
                history.setdefault(trial, []).append(statistics.fmean(scores))
            before = [m[step - 1] for m in others.values() if len(m) >= step]
            if step > warmup and len(before) >= startup and history[trial][-1] < statistics.median(before):
                states[trial] = "pruned"
                return
        states[trial] = "complete"

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for at in range(0, n_trials, block):
            list(pool.map(run, drawn[at : at + block]))

    done = [r for r in drawn if r["trial"] in states]
    values = [(r["trial"], history[r["trial"]][-1], states[r["trial"]]) for r in done]
    steps = [(t, s, v) for t, means in history.items() for s, v in enumerate(means, start=1)]
    table = spark.createDataFrame(values, "trial long, value double, state string")
    settings = search_trials(table.select("trial"), spec.strategy, spec.seed, limits=limits)
    result = SearchResult(
        settings.join(table, "trial"),
        spark.createDataFrame(steps, "trial long, step int, running_mean double"),
    )
    finished = [v for v in values if v[2] == "complete"]
    if finished:
        best = max(finished, key=lambda v: (v[1], -v[0]))
        row = next(r for r in drawn if r["trial"] == best[0])
        result.best_value = best[1]
        result.best_params = dict(row["model"])
        result.best_sampler = dict(row.get("sampler") or {})
    return result


def tuned(spec: TrainSpec, result: SearchResult) -> TrainSpec:
    """The spec with the best settings, each where it belongs."""
    return replace(spec, params=result.best_params, sampler=result.best_sampler)


def _prepare_folds(train: DataFrame, spec: TrainSpec, n_splits: int, parallelism: int) -> list[_Fold]:
    tagged = checkpointed(stratified_folds(train, spec.target, spec.key, n_splits, spec.seed, "_fold"))

    def prepare_fold(fold: int) -> _Fold:
        learn = tagged.where(F.col("_fold") != fold).drop("_fold")
        held = tagged.where(F.col("_fold") == fold).drop("_fold")
        prepare = spec.preprocessor().fit(learn)
        rows = checkpointed(to_vectors(prepare.transform(learn), spec.target, spec.key))
        if strategy_name(spec.strategy) != "none":
            rows = checkpointed(borderline_smote(rows, seed=spec.seed))
        return _Fold(rows, checkpointed(to_vectors(prepare.transform(held), spec.target, spec.key)))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(prepare_fold, range(n_splits)))


def _cleaned(fold: _Fold, strategy: str, sampler: dict, lock: Lock) -> DataFrame:
    """Cleaned rows of a fold, shared by trials that clean alike."""
    name = tuple(sorted(sampler.items()))
    with lock:
        guard = fold.guards.setdefault(name, Lock())
    with guard:  # whoever comes second waits for the first
        if name not in fold.cleaned:
            fold.cleaned[name] = checkpointed(clean_resampled(fold.grown, strategy, **sampler))
        return fold.cleaned[name]

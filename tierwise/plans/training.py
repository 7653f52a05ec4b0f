"""The whole training run: audit to stored reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tierwise.functions.lineage import checkpointed
from tierwise.operators import audit, explain, search, tiers
from tierwise.operators.boosting import RiskEstimator, TrainSpec, score
from tierwise.operators.metrics import classification_metrics
from tierwise.operators.preprocessing import feature_names
from tierwise.operators.split import drop_columns, split_summary, stratified_split, train_and_valid
from tierwise.operators.thresholds import select_threshold
from tierwise.sources.run_store import RunRecord, RunStore


@dataclass
class RunConfig:
    """Settings of a run, with the values a run uses when it says nothing."""

    target: str
    key: str
    drop: Sequence[str] = ()
    test_size: float = 0.20
    val_size: float = 0.15
    seed: int = 42
    clip_lower: float = 0.01
    clip_upper: float = 0.99
    numeric_rounds: int = 20
    categorical_rounds: int = 10
    categorical_trees: int = 50
    strategy: str = "borderline_smote_allknn"
    params: dict = field(default_factory=dict)
    baseline_threshold: float = 0.20
    n_splits: int = 5
    objective: str = "pr_auc"
    objective_top_pct: float = 0.55
    objective_pr_auc_weight: float = 0.40
    n_trials: int = 200
    timeout_seconds: float | None = None
    parallelism: int = 1
    search_limits: dict = field(default_factory=dict)
    threshold_strategy: str = "recall_100"
    min_precision: float = 0.20
    safety_margin: float = 0.30
    max_threshold: float | None = None
    critical_min_prob: float = 0.30
    high_min_prob: float = 0.15
    moderate_min_prob: float = 0.05
    background: int = 300
    explained: int = 500


@dataclass
class TrainRun:
    audit: DataFrame
    split: DataFrame
    split_sizes: DataFrame
    baseline: DataFrame
    baseline_summary: DataFrame
    search: search.SearchResult | None
    threshold: DataFrame
    model: PipelineModel
    tiers: list[dict]
    metrics: DataFrame
    stratified: DataFrame
    tier_summary: DataFrame
    tier_overall: DataFrame
    shap: DataFrame
    importance: DataFrame
    top_local: DataFrame
    base_value: float
    record: RunRecord | None = None


def run_training(
    df: DataFrame, config: RunConfig, store: RunStore | None = None, run_id: str | None = None
) -> TrainRun:
    """Fit, tune, choose a threshold on held-out rows, refit, and report on the test rows."""
    c = config
    audit.validate_schema(df, c.target, [c.target, c.key])
    report = audit.audit_report(df, c.target, [c.key])
    split = checkpointed(
        stratified_split(drop_columns(df, c.drop), c.target, c.key, c.test_size, c.val_size, c.seed)
    )
    parts = {p: split.where(F.col("split") == p).drop("split") for p in ("train", "valid", "test")}
    features = parts["train"].drop(c.target, c.key)
    numeric, categorical = audit.feature_types(features)
    spec = TrainSpec(
        c.target, c.key, numeric, categorical, dict(c.params), c.strategy, {},
        c.clip_lower, c.clip_upper, c.numeric_rounds, c.categorical_rounds, c.categorical_trees, c.seed,
    )

    baseline = search.baseline_cv(parts["train"], spec, c.n_splits, c.baseline_threshold, c.parallelism)
    found = None
    if c.n_trials:
        found = search.random_search(
            parts["train"], spec, c.n_splits, c.n_trials, c.objective, c.baseline_threshold,
            c.objective_top_pct, c.objective_pr_auc_weight, c.timeout_seconds, c.parallelism,
            limits=c.search_limits,
        )
        if found.best_params:
            spec = search.tuned(spec, found)

    tuned_model = RiskEstimator(spec).fit(parts["train"])
    threshold = checkpointed(
        select_threshold(
            score(tuned_model, parts["valid"], c.key, c.target),
            c.threshold_strategy, c.min_precision, c.safety_margin, c.max_threshold,
        )
    )
    cut = float(threshold.first()["threshold"])

    known = train_and_valid(split).drop("split")
    model = RiskEstimator(spec).fit(known)
    tier_list = tiers.fixed_probability_tiers(cut, c.critical_min_prob, c.high_min_prob, c.moderate_min_prob)
    scored = checkpointed(score(model, parts["test"], c.key, c.target))
    metrics = classification_metrics(scored, cut)
    stratified = tiers.stratify_risk(scored, tier_list, ["key", "y"])
    summary = tiers.tier_summary(stratified, tier_list)
    overall = tiers.tier_overall(stratified, cut)

    shap, importance, top_local, base = explain_run(model, known, parts["test"], c)
    run = TrainRun(
        report, split, split_summary(split, c.target), baseline, search.cv_summary(baseline), found,
        threshold, model, tier_list, metrics, stratified, summary, overall, shap, importance, top_local, base,
    )
    if store is not None:
        run.record = store.save(
            run_id, model, cut, c.objective, numeric, categorical, spec.params, tier_list
        )
        name = run_id or "unnamed"
        reports = {
            "data_audit": report, "baseline_cv": baseline, "threshold": threshold, "metrics": metrics,
            "tiers": summary, "tier_overall": overall, "tiered_rows": stratified, "shap_importance": importance,
        }
        if found is not None:
            reports["trials"] = found.trials
        for report_name, frame in reports.items():
            store.add_report(report_name, frame, name)
    return run


def explain_run(model: PipelineModel, known: DataFrame, rows: DataFrame, config: RunConfig):
    """Shapley values of a sample of rows against a sample of the rows fitted on."""
    prepare, boosted = model.stages
    names = feature_names(model)
    leaves = explain.read_leaves(explain.leaf_table(rows.sparkSession, boosted))

    def vectors(df: DataFrame, n: int) -> DataFrame:
        sample = explain.seeded_sample(df, config.key, n, config.seed)
        ready = boosted.transform(prepare.transform(sample.withColumn("_key", F.col(config.key))))
        p = F.get(vector_to_array("probability"), F.lit(1)).alias("p")
        return ready.select(F.col("_key").alias("key"), vector_to_array("features").alias("x"), p)

    background = explain.background_matrix(vectors(known, config.background), "key", "x", config.background)
    explained = checkpointed(
        vectors(rows, config.explained).withColumn(
            "shap", explain.shap_values(F.col("x"), leaves, background)
        )
    )
    long = explain.shap_long(explained, names)
    return (
        long,
        explain.shap_importance(long),
        explain.most_at_risk(explained, names),
        explain.interventional_base(leaves, background),
    )

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierwise.functions.ranking import hash_rank
from tierwise.operators import metrics as M, search, thresholds as T
from tierwise.operators.tiers import (
    assign_tier, attach_labels, default_tiers, fixed_probability_tiers, stratify_risk, tier_cut_report,
    tier_frame, tier_overall, tier_summary,
)


def scored(spark, pairs):
    return spark.createDataFrame([(i, y, p) for i, (y, p) in enumerate(pairs)], "key long, y int, p double")


@pytest.fixture(scope="module")
def tied(spark):
    """A third of the rows share one score."""
    rng = np.random.default_rng(5)
    p = np.where(rng.random(900) < 0.34, 0.5, rng.integers(0, 40, 900) / 40.0)
    y = (rng.random(900) < p * 0.4).astype(int)
    return scored(spark, [(int(a), float(b)) for a, b in zip(y, p)])


def test_one_class_and_no_rows(spark):
    one = M.classification_metrics(scored(spark, [(0, 0.1), (0, 0.9)]), 0.5).first()
    assert one["roc_auc"] is None and one["pr_auc"] == 0.0 and one["recall"] == 0.0 and one["fp"] == 1
    all_pos = M.classification_metrics(scored(spark, [(1, 0.1), (1, 0.9)]), 0.5).first()
    assert all_pos["specificity"] == 0.0 and all_pos["pr_auc"] == 1.0
    none = spark.createDataFrame([], "key long, y int, p double")
    assert M.threshold_metrics(none, 0.5).first()["recall"] == 0.0
    assert T.threshold_grid(none).count() == 200


def test_threshold_is_inclusive(spark):
    row = M.confusion_matrix(scored(spark, [(1, 0.5), (0, 0.5), (1, 0.49)]), 0.5).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (1, 1, 1, 0)


def test_curve_metrics_equal_pair_counting(spark, tied):
    pdf = tied.toPandas()
    pos, neg = pdf[pdf.y == 1].p.to_numpy(), pdf[pdf.y == 0].p.to_numpy()
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    got = M.classification_metrics(tied, 0.5).first()
    assert got["roc_auc"] == pytest.approx(auc)
    assert got["brier"] == pytest.approx(((pdf.p - pdf.y) ** 2).mean())


def test_bands_do_not_change_the_curve(spark, tied, monkeypatch):
    want = M.classification_metrics(tied, 0.5).first()
    monkeypatch.setattr(M, "BANDS", 3)
    assert tuple(M.classification_metrics(tied, 0.5).first()) == pytest.approx(tuple(want))


def test_top_share_takes_k_rows_and_breaks_ties_the_same_way(spark, tied):
    for pct in (0.001, 0.3, 0.5, 1.0):
        row = M.top_capture(tied, pct).first()
        assert row["k"] == max(1, math.ceil(900 * pct))
        again = M.top_capture(tied.repartition(5), pct).first()
        assert row == again
        assert row["captured"] <= min(row["k"], row["positives"])
    assert M.recall_at_top_pct(tied, 1.0).first()[0] == 1.0
    assert M.recall_at_top_pct(scored(spark, [(0, 0.2)]), 0.5).first()[0] == 0.0
    with pytest.raises(ValueError):
        M.recall_at_top_pct(tied, 0.0)


def test_grouped_metrics_equal_separate_ones(spark, tied):
    parts = tied.withColumn("g", (F.col("key") % 3).cast("int"))
    whole = {r["g"]: r for r in M.tiering_score(parts, 0.4, by=["g"]).collect()}
    for g in range(3):
        alone = M.tiering_score(parts.where(F.col("g") == g), 0.4).first()
        assert whole[g]["tiering_score"] == pytest.approx(alone["tiering_score"])


@pytest.mark.parametrize(
    "name",
    ["pr_auc", "roc_auc", "recall_at_top_pct", "precision_at_top_pct", "tiering_score", "recall", "f1", "F2"],
)
def test_objectives_have_a_score(tied, name):
    assert 0.0 <= M.objective_score(tied, name).first()["score"] <= 1.0


def test_unknown_objective_and_strategy(tied):
    with pytest.raises(ValueError):
        M.objective_score(tied, "accuracy")
    with pytest.raises(ValueError):
        T.select_threshold(tied, "best")


def test_tiering_weight_is_held_in_range(tied):
    ap = M.average_precision(tied).first()[0]
    assert M.tiering_score(tied, 0.5, 7.0).first()[0] == pytest.approx(ap)


def test_no_window_or_sort_covers_all_rows(spark, sf):
    df = spark.read.parquet(f"{sf}/events.parquet").selectExpr(
        "event_id as key", "cast(user_id % 2 as int) as y", "value / (value + 100) as p"
    )
    for made in (M.classification_metrics(df, 0.5), T.threshold_grid(df)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan
        scans_to_one = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
        # Only aggregates and the 201-row grid meet in one task.
        assert len(scans_to_one) <= 2
    ranked = hash_rank(df, "key", 1, "r")
    assert "SinglePartition" not in ranked.select("r")._jdf.queryExecution().executedPlan().toString().split("Window")[0]


def test_hash_rank_counts_from_one_without_gaps(spark):
    df = spark.range(500).selectExpr("id as key", "id % 2 as g")
    ranks = [r[0] for r in hash_rank(df, "key", 9, "r", ["g"]).where("g = 1").select("r").collect()]
    assert sorted(ranks) == list(range(1, 251))


def test_threshold_edge_cases(spark):
    no_pos = scored(spark, [(0, 0.2), (0, 0.4)])
    assert T.select_threshold(no_pos, "recall_100").first()["threshold"] == 0.001
    low = scored(spark, [(1, 0.0001), (0, 0.4)])
    assert T.select_threshold(low, "recall_100").first()["threshold"] == 0.001
    capped = T.select_threshold(scored(spark, [(1, 0.9), (0, 0.1)]), "recall_100", max_threshold=0.2).first()
    assert 0.19 < capped["threshold"] <= 0.2 and capped["max_threshold"] == 0.2
    none_feasible = T.select_threshold(scored(spark, [(1, 0.2), (0, 0.3), (0, 0.4)]), " Recall_At_Min_Precision ", 0.99)
    row = none_feasible.first()
    assert row["strategy"] == "recall_at_min_precision" and row["recall"] == 1.0
    first = T.select_threshold(scored(spark, [(1, 0.9), (0, 0.1)]), "maximize_f1").first()
    reached = [t for t in T.GRID if 0.1 < t <= 0.9]
    assert first["threshold"] == reached[0]


def test_grid_bins_agree_with_comparisons(spark):
    points = T.GRID + [t + 1e-12 for t in T.GRID] + [t - 1e-12 for t in T.GRID] + [0.0, 1.0]
    df = scored(spark, [(1, float(p)) for p in points])
    for row in T.threshold_grid(df).collect():
        want = sum(p >= row["threshold"] for p in points) / len(points)
        assert row["recall"] == pytest.approx(want, abs=1e-12)


def test_tier_rules():
    with pytest.raises(ValueError):
        fixed_probability_tiers(0.0, 0.3, 0.3, 0.1)
    lifted = fixed_probability_tiers(0.4)
    assert [t["min_prob"] for t in lifted] == [0.3, 0.15, 0.4 + 1e-6, 0.4]
    assert [t["min_prob"] for t in default_tiers()] == [0.15, 0.05, 0.01, 0.0]
    assert tier_cut_report(lifted)["low_min_prob"] == 0.4


def test_tier_assignment_by_cut_not_by_priority(spark):
    lifted = fixed_probability_tiers(0.4)
    df = scored(spark, [(1, 0.5), (0, 0.35), (0, 0.2), (1, 0.05)])
    labels = [r[0] for r in df.orderBy("key").select(assign_tier(F.col("p"), lifted)).collect()]
    assert labels == ["moderate", "critical", "high", "low"]
    none = [r[0] for r in df.orderBy("key").select(assign_tier(F.col("p"), lifted, None)).collect()]
    assert none == ["moderate", "critical", "high", None]


def test_empty_tiers_and_label_columns(spark):
    df = scored(spark, [(1, 0.5), (0, 0.4)])
    with_labels = tier_summary(stratify_risk(df, keep=["key", "y"]))
    rows = {r["risk_label"]: r for r in with_labels.collect()}
    assert rows["critical"]["precision"] == 0.5 and rows["low"]["count"] == 0 and rows["low"]["precision"] == 0.0
    assert "true_positives" not in tier_summary(stratify_risk(df)).columns
    assert tier_frame(spark, default_tiers()).count() == 4
    overall = tier_overall(stratify_risk(df, keep=["key", "y"])).first()
    assert overall["stage1_flagged"] == 2 and overall["stage1_threshold"] is None


def test_labels_must_match_rows(spark):
    df = scored(spark, [(1, 0.5), (0, 0.4)])
    strata = stratify_risk(df)
    assert attach_labels(strata, df.select("key", "y")).count() == 2
    with pytest.raises(ValueError):
        attach_labels(strata, df.where("key = 0").select("key", "y"))


def test_pruning_waits_for_warmup_and_startup(spark):
    rows = [(t, s, 0.9 - 0.01 * t) for t in range(8) for s in range(1, 5)]
    df = spark.createDataFrame(rows, "trial long, step int, running_mean double")
    cut = {(r["trial"], r["step"]) for r in search.median_prune(df).where("prune").collect()}
    assert cut == {(t, s) for t in (5, 6, 7) for s in (3, 4)}


def test_best_trial_is_the_first_of_equals_and_never_a_pruned_one(spark):
    df = spark.createDataFrame([(0, 0.9, "pruned"), (1, 0.5, "complete"), (2, 0.5, "complete")], "trial long, value double, state string")
    row = search.best_trial(df).first()
    assert (row["best_trial"], row["best_value"], row["n_trials"]) == (1, 0.5, 3)


def test_trials_of_one_block_do_not_see_each_other(spark):
    rows = [(t, s, 0.9 - 0.01 * t) for t in range(12) for s in range(1, 5)]
    df = spark.createDataFrame(rows, "trial long, step int, running_mean double")
    cut = {r["trial"] for r in search.median_prune(df, block=5).where("prune").collect()}
    assert cut == {5, 6, 7, 8, 9, 10, 11}
    seen = {r["trial"]: r["median_before"] for r in search.median_prune(df, block=5).where("step = 4").collect()}
    assert seen[3] is None and seen[5] == seen[9] == pytest.approx(0.88) and seen[10] == pytest.approx(0.855)

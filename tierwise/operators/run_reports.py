"""Comparing runs by their metric rows and tier reports.

``metrics`` holds one row per run, ``tiers`` one row per run and tier.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.operators.metrics import ratio

TIERS = ("critical", "high", "moderate", "low")
CELLS = ("tn", "fp", "fn", "tp")
METRICS = ("threshold", "pr_auc", "roc_auc", "recall", "precision", "specificity", "brier")


def run_collect(metrics: DataFrame, tiers: DataFrame) -> DataFrame:
    """Runs that have both reports, oldest id first; others are left out."""
    with_tiers = tiers.select("run_id").distinct()
    return metrics.join(with_tiers, "run_id", "left_semi").select("run_id").orderBy("run_id")


def run_summary(metrics: DataFrame, tiers: DataFrame) -> DataFrame:
    """One row per run: metrics, tier sizes and hits, and the load of the upper three tiers."""

    def pick(tier: str, column: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("risk_label") == tier, F.col(column))), F.lit(0))

    sizes = tiers.groupBy("run_id").agg(
        *[pick(t, "count").alias(f"{t}_n") for t in TIERS],
        *[pick(t, "true_positives").alias(f"{t}_tp") for t in TIERS],
    )
    top_n = F.col("critical_n") + F.col("high_n") + F.col("moderate_n")
    top_tp = F.col("critical_tp") + F.col("high_tp") + F.col("moderate_tp")
    joined = metrics.join(sizes, "run_id")
    values = [F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in METRICS if m in metrics.columns]
    cells = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in CELLS if c in metrics.columns]
    return joined.select(
        "run_id",
        *values,
        *[f"{t}_n" for t in TIERS],
        *[f"{t}_tp" for t in TIERS],
        top_n.alias("top_n"),
        top_tp.alias("top_tp"),
        ratio(top_n, top_n + F.col("low_n")).alias("top_rate"),
        ratio(top_tp, top_tp + F.col("low_tp")).alias("top_recall"),
        *cells,
    )


def run_tier_rates(tiers: DataFrame) -> DataFrame:
    """Rows, hits and positive rate of every tier of every run."""
    return tiers.select(
        "run_id",
        "risk_label",
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("true_positives", F.lit(0)).alias("true_positives"),
        F.round(ratio(F.col("true_positives"), F.col("count")) * 100.0, 1).alias("rate_pct"),
    )


def run_confusion_shares(metrics: DataFrame) -> DataFrame:
    """Each confusion cell with its share of all rows."""
    total = sum((F.col(c) for c in CELLS), F.lit(0))
    cells = F.array(*[F.struct(F.lit(c).alias("cell"), F.col(c).alias("count")) for c in CELLS])
    return metrics.select("run_id", total.alias("_total"), F.explode(cells).alias("_c")).select(
        "run_id",
        "_c.cell",
        "_c.count",
        F.round(ratio(F.col("_c.count"), F.col("_total")) * 100.0, 1).alias("share_pct"),
    )


def run_trend(summary: DataFrame) -> DataFrame:
    """Recall, PR-AUC, workload and Brier over the runs, with the change from the run before.

    The window covers runs, not rows; with a single run there is no trend and no row.
    """
    order = Window.orderBy("run_id")
    every = Window.partitionBy()
    tracked = ("recall", "pr_auc", "top_n", "brier")
    return (
        summary.select(
            "run_id",
            F.row_number().over(order).alias("position"),
            *tracked,
            *[(F.col(c) - F.lag(c).over(order)).alias(f"{c}_change") for c in tracked],
            F.count(F.lit(1)).over(every).alias("_runs"),
        )
        .where("_runs >= 2")
        .drop("_runs")
    )


def run_latest(summary: DataFrame, records: DataFrame) -> DataFrame:
    """Summary row of the run recorded last; an error if it has no reports."""
    latest = records.agg(F.max_by("run_id", F.struct("created", "run_id")).alias("run_id"))
    row = latest.first()
    if row is None or row["run_id"] is None:
        raise FileNotFoundError("no run has been recorded")
    found = summary.where(F.col("run_id") == row["run_id"])
    if found.isEmpty():
        raise FileNotFoundError(f"run {row['run_id']!r} has no reports")
    return found

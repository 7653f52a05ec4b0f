"""Risk tiers: cut-offs, assignment of scored rows, and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwise.functions.fixed_values import DEFAULT_TIER_CUTS, TIER_TABLE
from tierwise.operators.metrics import ratio

Tier = dict

TIER_SCHEMA = (
    "label string, name string, name_en string, color string, priority int, "
    "clinical_action string, followup string, min_prob double"
)
NOTE = (
    "Every scored row belongs to a tier. The stage-1 threshold is an alert gate; "
    "tiers set the order of follow-up."
)


def _with_cuts(cuts: Sequence[float]) -> list[Tier]:
    return [{**tier, "min_prob": float(cut)} for tier, cut in zip(TIER_TABLE, cuts)]


def default_tiers() -> list[Tier]:
    return _with_cuts(DEFAULT_TIER_CUTS)


def fixed_probability_tiers(
    stage1_threshold: float,
    critical_min_prob: float = 0.30,
    high_min_prob: float = 0.15,
    moderate_min_prob: float = 0.05,
) -> list[Tier]:
    """Tiers at absolute cut-offs; moderate is lifted just above the stage-1 gate."""
    if not 0.0 < moderate_min_prob < high_min_prob < critical_min_prob <= 1.0:
        raise ValueError("cut-offs must satisfy 0 < moderate < high < critical <= 1")
    moderate = max(moderate_min_prob, stage1_threshold + 1e-6)
    return _with_cuts([critical_min_prob, high_min_prob, moderate, stage1_threshold])


def tier_cut_report(tiers: Sequence[Tier]) -> dict:
    """The cut-offs in use, for the run record."""
    cuts = {f"{t['label']}_min_prob": t["min_prob"] for t in tiers}
    return {"mode": "fixed_probability", **cuts}


def tier_frame(spark: SparkSession, tiers: Sequence[Tier]) -> DataFrame:
    names = [part.split()[0] for part in TIER_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(t[n] for n in names) for t in tiers], TIER_SCHEMA)


def assign_tier(p: Column, tiers: Sequence[Tier], below_all: str | None = "last") -> Column:
    """Label of the tier with the highest ``min_prob`` not above ``p``.

    Below every cut-off a row falls to the tier of largest priority number, or to no tier
    at all with ``below_all=None``.
    """
    label = F.lit(None).cast("string")
    if below_all == "last":
        label = F.lit(max(tiers, key=lambda t: t["priority"])["label"])
    for tier in sorted(tiers, key=lambda t: t["min_prob"]):
        label = F.when(p >= F.lit(tier["min_prob"]), F.lit(tier["label"])).otherwise(label)
    return label


def tier_field(label: Column, tiers: Sequence[Tier], field: str) -> Column:
    """A property of the labelled tier, as an expression over at most a few literals."""
    value = F.lit(None)
    for tier in tiers:
        value = F.when(label == F.lit(tier["label"]), F.lit(tier[field])).otherwise(value)
    return value


def stratify_risk(
    scored: DataFrame, tiers: Sequence[Tier] | None = None, keep: Sequence[str] = ("key",)
) -> DataFrame:
    """Tier of every row, taken from the unrounded score.

    The frame is not sorted here: ``stratify_sorted`` orders it for a report.
    """
    tiers = tiers or default_tiers()
    labelled = scored.withColumn("risk_label", assign_tier(F.col("p"), tiers))
    label = F.col("risk_label")
    return labelled.select(
        *keep,
        F.round("p", 6).alias("probability"),
        "risk_label",
        tier_field(label, tiers, "name").alias("risk_name"),
        tier_field(label, tiers, "priority").cast("int").alias("priority"),
        tier_field(label, tiers, "clinical_action").alias("clinical_action"),
        tier_field(label, tiers, "followup").alias("followup"),
        tier_field(label, tiers, "color").alias("color"),
    )


def stratify_sorted(stratified: DataFrame, key: str = "key") -> DataFrame:
    """Most urgent tier first; the key as second order spreads a large tier over tasks."""
    return stratified.orderBy("priority", key)


def attach_labels(stratified: DataFrame, labels: DataFrame, key: str = "key") -> DataFrame:
    """Pair tiered rows with their labels by key; both sides must hold the same keys."""
    paired = stratified.join(labels, key, "full_outer")
    bad = paired.where(F.col("risk_label").isNull() | F.col("y").isNull()).limit(1).count()
    if bad:
        raise ValueError("labels do not match the tiered rows")
    return paired


def tier_summary(
    stratified: DataFrame, tiers: Sequence[Tier] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Rows per tier, with hits when a label ``y`` is present; empty tiers show zeros."""
    tiers = tiers or default_tiers()
    labelled = "y" in stratified.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    if labelled:
        aggs.append(F.count_if(F.col("y") == 1).alias("_tp"))
        aggs.append(F.count_if(F.col("y") == 0).alias("_fp"))
    counts = stratified.groupBy(*by, "risk_label").agg(*aggs)
    # One row per group carrying all tiers, so that empty tiers are kept.
    packed = counts.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("risk_label", F.struct(*counts.columns[len(by) + 1 :])))).alias(
            "_by_label"
        )
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(t["label"]).alias("risk_label"),
                F.lit(t["name"]).alias("name"),
                F.lit(t["priority"]).alias("priority"),
                F.lit(t["min_prob"]).alias("min_prob"),
                F.lit(t["followup"]).alias("followup"),
                F.lit(t["clinical_action"]).alias("clinical_action"),
                F.col("_by_label")[t["label"]].alias("_c"),
            )
            for t in tiers
        ]
    )
    rows = packed.select(*by, F.explode(cells).alias("_t")).select(*by, "_t.*")

    def count_of(name: str) -> Column:
        return F.coalesce(F.col(f"_c.{name}"), F.lit(0))

    columns = [
        *by,
        "risk_label",
        "name",
        "priority",
        "min_prob",
        "followup",
        "clinical_action",
        count_of("_n").alias("count"),
    ]
    if labelled:
        share = ratio(count_of("_tp"), count_of("_n"))
        columns += [
            count_of("_tp").alias("true_positives"),
            count_of("_fp").alias("false_positives"),
            F.round(share, 4).alias("precision"),
            F.round(share * 100.0, 1).alias("positive_rate_pct"),
        ]
    return rows.select(*columns)


def tier_overall(
    stratified: DataFrame, stage1_threshold: float | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Positives overall and behind the stage-1 gate, which tests the rounded score."""
    positive = F.col("y") == 1
    gate = F.lit(True)
    if stage1_threshold is not None:
        gate = F.col("probability") >= F.lit(float(stage1_threshold))
    counts = stratified.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_flagged"),
        F.count_if(positive).alias("total_positive_cases"),
        F.count_if(positive & F.col("risk_label").isNotNull()).alias("captured_by_tiers"),
        F.count_if(gate).alias("stage1_flagged"),
        F.count_if(gate & positive).alias("captured_by_stage1"),
    )
    return counts.select(
        *by,
        "total_flagged",
        "total_positive_cases",
        "captured_by_tiers",
        F.lit(stage1_threshold).cast("double").alias("stage1_threshold"),
        "stage1_flagged",
        "captured_by_stage1",
        F.round(ratio(F.col("captured_by_stage1"), F.col("total_positive_cases")), 4).alias("stage1_recall"),
        F.lit(NOTE).alias("note"),
    )

"""Scoring new records with a finished run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tierwise.operators.boosting import positive_probability
from tierwise.operators.explain import Leaf, shap_values, top_contributions
from tierwise.operators.preprocessing import feature_names
from tierwise.operators.tiers import Tier, assign_tier, tier_field


def score_records(
    rows: DataFrame,
    model: PipelineModel,
    leaves: Sequence[Leaf],
    threshold: float,
    tiers: Sequence[Tier] = (),
    key: str = "key",
    run_id: str | None = None,
    top_k: int = 5,
) -> DataFrame:
    """Probability, label, tier and main reasons of every record.

    Every record is answered by itself, so ``rows`` may also be a stream.  A record below
    all cut-offs has no tier.
    """
    names = feature_names(model)
    scored = model.transform(rows.withColumn("_key", F.col(key)))
    scored = scored.withColumn("_x", vector_to_array("features")).withColumn("_p", positive_probability())
    scored = scored.withColumn("_shap", shap_values(F.col("_x"), leaves))
    columns = [
        F.col("_key").alias("key"),
        F.lit(run_id).cast("string").alias("run_id"),
        F.lit(float(threshold)).alias("threshold"),
        F.col("_p").alias("predicted_probability"),
        (F.col("_p") >= F.lit(float(threshold))).cast("int").alias("predicted_label"),
        top_contributions(names, F.col("_x"), F.col("_shap"), top_k).alias("explanation"),
    ]
    if tiers:
        scored = scored.withColumn("_tier", assign_tier(F.col("_p"), tiers, below_all=None))
        tier = F.col("_tier")
        columns += [
            tier_field(tier, tiers, "name").alias("risk_tier"),
            tier_field(tier, tiers, "clinical_action").alias("clinical_action"),
            tier_field(tier, tiers, "followup").alias("followup_recommendation"),
        ]
    return scored.select(*columns)

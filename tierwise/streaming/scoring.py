"""Scoring a stream of records: the batch plan, unchanged, over a streaming source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tierwise.operators.explain import Leaf
from tierwise.operators.tiers import Tier
from tierwise.plans.scoring import score_records


def read_record_stream(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON records arriving as files below ``path``."""
    return spark.readStream.schema(schema).json(path)


def score_stream(
    records: DataFrame,
    model: PipelineModel,
    leaves: Sequence[Leaf],
    threshold: float,
    tiers: Sequence[Tier],
    out: str,
    checkpoint: str,
    key: str = "key",
    run_id: str | None = None,
) -> StreamingQuery:
    """Append scored records to ``out`` until the available input is used up."""
    scored = score_records(records, model, leaves, threshold, tiers, key, run_id)
    return (
        scored.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )

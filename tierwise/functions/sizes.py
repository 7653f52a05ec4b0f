"""Measured sizes of tables that may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

BROADCAST_BYTES = 64 << 20
CELL_BYTES = 16


def is_small(df: DataFrame) -> bool:
    """Whether the rows, read once, come to at most BROADCAST_BYTES."""
    texts = [F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) for f in df.schema if isinstance(f.dataType, T.StringType)]
    row = sum(texts, F.lit(CELL_BYTES * (1 + len(df.columns)))).cast("long")
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0] <= BROADCAST_BYTES

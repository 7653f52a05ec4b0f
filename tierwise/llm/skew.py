"""Joins whose left side may hold any share of its rows under one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Rows of one key that stay together.  There are at most (rows / HEAVY) heavier keys.
HEAVY = 50_000


def heavy_keys(counts: DataFrame, key: str, n: str) -> DataFrame | None:
    """``key, _slices`` of the keys of ``counts`` with more rows than stay together; None without any."""
    heavy = counts.where(F.col(n) > HEAVY).select(key, F.ceil(F.col(n) / HEAVY).cast("int").alias("_slices"))
    return None if heavy.isEmpty() else heavy


def spread_join(
    rows: DataFrame, lookup: DataFrame, key: str, heavy: DataFrame | None, spread: Sequence[str], how: str = "inner"
) -> DataFrame:
    """``rows`` joined with ``lookup``, which has one row a key; rows of a heavy key are dealt out.

    ``heavy`` is from ``heavy_keys`` over counts of ``rows``: one row for each HEAVY rows at most,
    so it is broadcast; without any this is a plain join.  Rows are dealt by a hash of the
    ``spread`` columns and the lookup's row stands in every slice.
    """
    if heavy is None:
        return rows.join(lookup, key, how)
    heavy = F.broadcast(heavy)
    dealt = rows.join(heavy, key, "left").withColumn("_slice", F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_slices")), F.lit(0)).cast("int"))
    copied = lookup.join(heavy, key, "left").withColumn("_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", F.lit(1)) - 1)))
    return dealt.drop("_slices").join(copied.drop("_slices"), [key, "_slice"], how).drop("_slice")

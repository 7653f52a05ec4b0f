"""Exact ranks over groups of any size.

A window over a whole class would sort most of the table in one task.  Rows are ordered
by a hash here, and the leading hex digits of a hash cut every group into slices of near
equal size, already in order.  Counting the slices places all rows but those of one slice
per cut, so only that slice is ever sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.functions.hashing import order_hash

SLICE_DIGITS = 4
FEW_GROUPS = 100_000  # up to here one row per group may be broadcast


def _sliced(df: DataFrame, key: str, seed: int) -> DataFrame:
    hashed = df.withColumn("_hash", order_hash(F.col(key), seed))
    return hashed.withColumn("_slice", F.substring("_hash", 1, SLICE_DIGITS))


def _slice_counts(sliced: DataFrame, by: Sequence[str], *extra: Column) -> DataFrame:
    counts = sliced.groupBy(*by, "_slice").agg(F.count(F.lit(1)).alias("_n"), *extra)
    # At most 16^SLICE_DIGITS rows per group reach this window.
    upto = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn("_upto", F.sum("_n").over(upto))


def hash_cuts(df: DataFrame, by: Sequence[str], key: str, seed: int, ranks: Column) -> DataFrame:
    """The rows found at given ranks of the hash order inside each group.

    ``ranks`` is an array of 1-based ranks written over ``_total``, the group size.
    Returns ``by``, ``cut`` (position in ``ranks``), ``cut_hash`` and ``cut_key``.
    There must be few groups: their cuts are broadcast, so that only rows of the slices
    that hold a cut are shuffled.
    """
    by = list(by)
    sliced = _sliced(df.select(*by, key), key, seed)
    counts = _slice_counts(sliced, by)
    counts = counts.withColumn("_total", F.sum("_n").over(Window.partitionBy(*by)))
    wanted = counts.select("*", F.posexplode(ranks).alias("cut", "_rank"))
    hit = wanted.where("_upto - _n < _rank and _rank <= _upto").select(
        *by, "_slice", "cut", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_need")
    )
    edge = _null_safe_join(sliced, hit, [*by, "_slice"], small=True)
    within = Window.partitionBy(*by, "_slice", "cut").orderBy("_hash", key)
    return (
        edge.withColumn("_rn", F.row_number().over(within))
        .where("_rn = _need")
        .select(*by, "cut", F.col("_hash").alias("cut_hash"), F.col(key).alias("cut_key"))
    )


def hash_rank(df: DataFrame, key: str, seed: int, out: str, by: Sequence[str] = ()) -> DataFrame:
    """1-based rank of every row in the hash order of its group."""
    by = list(by)
    sliced = _sliced(df, key, seed)
    offsets = _slice_counts(sliced, by).select(
        *by, "_slice", (F.col("_upto") - F.col("_n")).alias("_before")
    )
    within = Window.partitionBy(*by, "_slice").orderBy("_hash", key)
    ranked = _null_safe_join(sliced, offsets, [*by, "_slice"])
    return ranked.withColumn(out, F.row_number().over(within) + F.col("_before")).drop(
        "_hash", "_slice", "_before"
    )


def take_by_hash(
    df: DataFrame, by: Sequence[str], key: str, seed: int, need: str, value: Column, few: bool
) -> DataFrame:
    """Sum ``value`` over the first ``need`` rows (a column) of each group's hash order.

    ``few`` says that the groups are known to be FEW_GROUPS at most.
    """
    by = list(by)
    sliced = _sliced(df.select(*by, key, need, value.alias("_value")), key, seed)
    counts = _slice_counts(
        sliced, by, F.sum("_value").alias("_sum"), F.max(need).alias("_take")
    )
    whole = counts.where("_upto <= _take").groupBy(*by).agg(F.sum("_sum").alias("_got"))
    hit = counts.where("_upto - _n < _take and _take < _upto").select(
        *by, "_slice", (F.col("_take") - F.col("_upto") + F.col("_n")).alias("_left")
    )
    within = Window.partitionBy(*by, "_slice").orderBy("_hash", key)
    part = (
        _null_safe_join(sliced, hit, [*by, "_slice"], small=few)
        .withColumn("_rn", F.row_number().over(within))
        .where("_rn <= _left")
        .groupBy(*by)
        .agg(F.sum("_value").alias("_got"))
    )
    return whole.unionByName(part).groupBy(*by).agg(F.sum("_got").alias("taken"))


def _null_safe_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], small: bool = False
) -> DataFrame:
    """Inner join that lets a null group meet itself and keeps one copy of the key columns."""
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    if small:
        right = F.broadcast(right)
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    return left.join(right, cond).drop(*[f"_r_{c}" for c in on])

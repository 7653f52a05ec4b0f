"""Exact stratified splits and folds.

Inside each class rows are ordered by a seeded hash of the key and cut at exact ranks.
Finding the cuts reads only key and target; assigning a row is then a comparison with a
handful of constants, so the table itself is never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.functions.hashing import order_hash
from tierwise.functions.ranking import hash_cuts, hash_rank

MAX_CLASSES = 1000
PARTS = ("test", "valid", "train")


def stratified_split(
    df: DataFrame, target: str, key: str, test_size: float, val_size: float, seed: int
) -> DataFrame:
    """Add ``split``: per class ceil(n*test) test rows, then ceil(rest*val/(1-test)) valid rows."""
    if not 0.0 < test_size < 1.0:
        raise ValueError("test_size must lie in (0, 1)")
    if not 0.0 < val_size < 1.0:
        raise ValueError("val_size must lie in (0, 1)")
    if test_size + val_size >= 1.0:
        raise ValueError("test_size + val_size must be below 1")
    total = F.col("_total")
    n_test = F.ceil(total * F.lit(test_size))
    n_valid = F.ceil((total - n_test) * F.lit(val_size / (1.0 - test_size)))
    parted = _with_part(df, target, key, seed, F.array(n_test, n_test + n_valid))
    names = F.array(*[F.lit(p) for p in PARTS])
    return parted.withColumn("split", F.element_at(names, F.col("_part") + 1)).drop("_part")


def split_summary(split: DataFrame, target: str) -> DataFrame:
    return split.groupBy("split", F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("count"))


def stratified_folds(
    df: DataFrame, target: str, key: str, n_splits: int, seed: int, out: str = "fold"
) -> DataFrame:
    """Add a fold number 0..n-1; each class is spread with sizes that differ by one at most."""
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2")
    ranks = F.array(
        *[F.ceil(F.col("_total") * F.lit(i) / F.lit(float(n_splits))) for i in range(1, n_splits)]
    )
    parted = _with_part(df, target, key, seed, ranks)
    return parted.withColumn(out, F.col("_part").cast("int")).drop("_part")


def train_and_valid(split: DataFrame) -> DataFrame:
    return split.where(F.col("split").isin("train", "valid"))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop identifiers and unused columns; absent names are ignored."""
    return df.drop(*columns)


def _with_part(df: DataFrame, target: str, key: str, seed: int, ranks: Column) -> DataFrame:
    """Add ``_part``: how many cuts lie before each row in the order of its class.

    With few classes the cuts are constants of the plan; more are ranked with a shuffle.
    """
    if df.select(target).distinct().limit(MAX_CLASSES + 1).count() > MAX_CLASSES:
        totals = df.groupBy(F.col(target).alias("_class")).agg(F.count(F.lit(1)).alias("_total"))
        ranked = hash_rank(df, key, seed, "_rank", by=[target])
        joined = ranked.join(totals, F.col(target).eqNullSafe(F.col("_class")))
        before = F.size(F.filter(ranks, lambda rank: rank < F.col("_rank")))
        return joined.withColumn("_part", before).drop("_class", "_total", "_rank")
    classes: dict = {}
    for row in hash_cuts(df, [target], key, seed, ranks).collect():  # one row per class and cut
        classes.setdefault(row[0], {})[row["cut"]] = (row["cut_hash"], row["cut_key"])
    hashed = F.col("_hash")
    part = F.lit(0)
    for value, cuts in classes.items():
        passed = F.lit(0)
        for cut_hash, cut_key in cuts.values():
            after = (hashed > cut_hash) | ((hashed == cut_hash) & (F.col(key) > F.lit(cut_key)))
            passed = passed + after.cast("int")
        part = F.when(F.col(target).eqNullSafe(F.lit(value)), passed).otherwise(part)
    return df.withColumn("_hash", order_hash(F.col(key), seed)).withColumn("_part", part).drop("_hash")

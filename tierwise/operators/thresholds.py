"""Choosing a decision threshold on an even grid.

Each score is binned to the highest grid point it reaches; the grid then needs running
sums over its own 200 points only, whatever the number of scored rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.functions.fixed_values import GRID_POINTS, GRID_START, GRID_STOP
from tierwise.operators.metrics import f_beta, ratio

STEP = (GRID_STOP - GRID_START) / (GRID_POINTS - 1)


def grid_value(i: int) -> float:
    return GRID_STOP if i == GRID_POINTS - 1 else GRID_START + i * STEP


GRID = [grid_value(i) for i in range(GRID_POINTS)]


def _highest_reached(p: Column) -> Column:
    """Index of the highest grid point <= p, or -1; the guess is checked against real points."""
    grid = F.array(*[F.lit(v) for v in GRID])
    guess = F.floor((p - F.lit(GRID_START)) / F.lit(STEP)).cast("int")
    guess = F.least(F.greatest(guess, F.lit(-1)), F.lit(GRID_POINTS - 1))
    up = (guess < GRID_POINTS - 1) & (F.get(grid, guess + 1) <= p)
    down = (guess >= 0) & (F.get(grid, guess) > p)
    return F.when(up, guess + 1).when(down, guess - 1).otherwise(guess)


def threshold_grid(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and F2 at every grid point."""
    p = F.col("p").cast("double")
    binned = (
        scored.select(_highest_reached(p).alias("at"), F.col("y").cast("bigint").alias("y"))
        .groupBy("at")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("tp"))
    )
    spark = scored.sparkSession
    points = spark.createDataFrame(
        [(-1, None), *enumerate(GRID)], "grid_at int, threshold double"
    )
    # Both sides hold at most 201 rows.
    joined = points.join(F.broadcast(binned), F.col("grid_at") == F.col("at"), "left")
    reached = Window.orderBy(F.desc("grid_at")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy()  # 201 rows
    counts = joined.select(
        "grid_at",
        "threshold",
        F.coalesce(F.sum("tp").over(reached), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("n").over(reached), F.lit(0)).alias("flagged"),
        F.coalesce(F.sum("tp").over(everything), F.lit(0)).alias("positives"),
    ).where("grid_at >= 0")
    precision = ratio(F.col("tp"), F.col("flagged"))
    recall = ratio(F.col("tp"), F.col("positives"))
    return counts.select(
        "threshold",
        precision.alias("precision"),
        recall.alias("recall"),
        f_beta(precision, recall, 1.0).alias("f1"),
        f_beta(precision, recall, 2.0).alias("f2"),
    )


# Metrics to maximise, in order; the first grid point wins among equals.
_ORDERS = {
    "maximize_f1": ("f1", "recall", "precision"),
    "maximize_f2": ("f2", "recall", "precision"),
    "maximize_recall": ("recall", "precision", "f1"),
}
STRATEGIES = (*_ORDERS, "recall_100", "recall_at_min_precision")


def select_threshold(
    scored: DataFrame,
    strategy: str,
    min_precision: float = 0.15,
    safety_margin: float = 1.0,
    max_threshold: float | None = None,
) -> DataFrame:
    """One row: the inputs of the choice and the grid point chosen."""
    name = strategy.lower().strip()
    if name not in STRATEGIES:
        raise ValueError(f"unknown threshold strategy {strategy!r}; use one of {list(STRATEGIES)}")
    grid = threshold_grid(scored)
    if name in _ORDERS:
        best = grid.orderBy(*[F.desc(m) for m in _ORDERS[name]], "threshold").limit(1)
    elif name == "recall_100":
        best = _below_lowest_positive(scored, grid, safety_margin, max_threshold)
    else:
        best = _feasible_first(grid, min_precision)
    return best.select(
        F.lit(name).alias("strategy"),
        F.lit(float(min_precision)).alias("min_precision"),
        F.lit(float(safety_margin)).alias("safety_margin"),
        F.lit(None if max_threshold is None else float(max_threshold)).cast("double").alias("max_threshold"),
        "threshold",
        "precision",
        "recall",
        "f1",
        "f2",
    )


def _below_lowest_positive(scored, grid, safety_margin, max_threshold) -> DataFrame:
    """Highest grid point not above the lowest positive score times the margin."""
    target = F.min(F.when(F.col("y") == 1, F.col("p").cast("double"))) * F.lit(float(safety_margin))
    if max_threshold is not None:
        target = F.when(target.isNotNull(), F.least(target, F.lit(float(max_threshold))))
    lowest = F.lit(GRID[0])
    target = F.greatest(F.coalesce(target, lowest), lowest)
    bound = scored.agg(target.alias("_target")).withColumn("_one", F.lit(1))
    reached = grid.withColumn("_grid_one", F.lit(1)).join(
        F.broadcast(bound), (F.col("_one") == F.col("_grid_one")) & (F.col("threshold") <= F.col("_target"))
    )
    return reached.orderBy(F.desc("threshold")).limit(1)


def _feasible_first(grid: DataFrame, min_precision: float) -> DataFrame:
    """Best recall among points precise enough; without any, the best F2."""
    ok = F.col("precision") >= F.lit(float(min_precision))
    return grid.orderBy(
        F.when(ok, 0).otherwise(1),
        F.desc(F.when(ok, F.col("recall")).otherwise(F.col("f2"))),
        F.desc(F.when(ok, F.col("f2")).otherwise(F.col("recall"))),
        F.desc(F.when(ok, F.lit(0.0)).otherwise(F.col("precision"))),
        F.asc("threshold"),
    ).limit(1)

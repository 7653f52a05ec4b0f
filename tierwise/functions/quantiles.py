"""Exact linear-interpolation quantiles without holding a column in one task.

Spark's ``percentile`` keeps every distinct value of the column in a single aggregation
buffer.  That is right for up to ``small`` rows.  Beyond it, an approximate sketch gives a
bracket around each wanted rank, counting fixes how many rows lie below the bracket, and
only the rows inside are looked at again, until few enough are left to order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

SMALL = 1_000_000
ACCURACY = 10_000


def as_double(name: str) -> Column:
    """The column as a double with NaN read as missing."""
    value = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(value), value)


@dataclass
class _Target:
    column: str
    prob: float
    first: int  # 0-based ranks whose values are interpolated
    last: int
    at: float
    low: float = -math.inf
    high: float = math.inf
    below: int = 0
    inside: int = 0

    def condition(self) -> Column:
        return as_double(self.column).between(F.lit(self.low), F.lit(self.high))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], small: int = SMALL
) -> dict[str, list[float | None]]:
    """Quantiles of each column at ``probs``; ``None`` for a column without values."""
    columns = list(columns)
    if not columns:
        return {}
    if df.count() <= small:
        points = F.array(*[F.lit(float(p)) for p in probs])
        row = df.agg(
            *[F.percentile(as_double(c), points).alias(f"c{i}") for i, c in enumerate(columns)]
        ).first()
        return {c: list(row[i]) if row[i] is not None else [None] * len(probs) for i, c in enumerate(columns)}

    counts = df.agg(*[F.count(as_double(c)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    sizes = {c: counts[i] for i, c in enumerate(columns)}
    targets = []
    for c in columns:
        for p in probs:
            if sizes[c]:
                at = (sizes[c] - 1) * float(p)
                targets.append(_Target(c, p, math.floor(at), math.ceil(at), at, inside=sizes[c]))
    _narrow(df, targets, small)
    values = _pick(df, targets)
    out: dict[str, list[float | None]] = {c: [None] * len(probs) for c in columns}
    for i, t in enumerate(targets):
        lo, hi = values[(i, t.first)], values[(i, t.last)]
        # Weighted as ``percentile`` does, to the last digit.
        value = lo if t.first == t.last or lo == hi else (t.last - t.at) * lo + (t.at - t.first) * hi
        out[t.column][list(probs).index(t.prob)] = value
    return out


def _narrow(df: DataFrame, targets: list[_Target], small: int) -> None:
    open_targets = [t for t in targets if t.inside > small]
    while open_targets:
        # Targets that look at the same values share one sketch.
        shared: dict[tuple, list[_Target]] = {}
        for t in open_targets:
            shared.setdefault((t.column, t.low, t.high), []).append(t)
        exprs = []
        for i, group in enumerate(shared.values()):
            probs = []
            for t in group:
                probs.append(max(0.0, (t.first - t.below) / t.inside - 2 / ACCURACY))
                probs.append(min(1.0, (t.last - t.below + 1) / t.inside + 2 / ACCURACY))
            value = F.when(group[0].condition(), as_double(group[0].column))
            points = F.array(*[F.lit(p) for p in probs])
            exprs.append(F.percentile_approx(value, points, F.lit(ACCURACY)).alias(f"b{i}"))
        row = df.agg(*exprs).first()
        bounds = {}
        for i, group in enumerate(shared.values()):
            for j, t in enumerate(group):
                bounds[id(t)] = (row[i][2 * j], row[i][2 * j + 1])
        checks = []
        for i, t in enumerate(open_targets):
            lo, hi = bounds[id(t)]
            value = as_double(t.column)
            checks.append(F.count_if(value < F.lit(lo)).alias(f"l{i}"))
            checks.append(F.count_if(value.between(F.lit(lo), F.lit(hi))).alias(f"m{i}"))
        found = df.agg(*checks).first()
        still = []
        for i, t in enumerate(open_targets):
            below, inside = found[2 * i], found[2 * i + 1]
            covered = below <= t.first and t.last < below + inside
            if not covered or inside == t.inside:
                continue  # ties only: the rest is settled on distinct values
            (t.low, t.high), t.below, t.inside = bounds[id(t)], below, inside
            if t.inside > small and t.low < t.high:
                still.append(t)
        open_targets = still


def _pick(df: DataFrame, targets: list[_Target]) -> dict[tuple[int, int], float]:
    out = {}
    open_targets = {}
    for i, t in enumerate(targets):
        if t.low == t.high:  # the bracket closed on one value
            out[(i, t.first)] = out[(i, t.last)] = t.low
        else:
            open_targets[i] = t
    if not open_targets:
        return out
    inside = F.lit(False)
    for t in open_targets.values():
        inside = inside | F.coalesce(t.condition(), F.lit(False))
    cells = F.array(
        *[
            F.when(
                t.condition(),
                F.struct(F.lit(i).alias("target"), as_double(t.column).alias("value")),
            )
            for i, t in open_targets.items()
        ]
    )
    counted = (
        df.where(inside)
        .select(F.explode(F.array_compact(cells)).alias("cell"))
        .groupBy("cell.target", "cell.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("target").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    counted = counted.withColumn("upto", F.sum("n").over(upto))
    wanted = F.lit(False)
    for i, t in open_targets.items():
        for rank in {t.first - t.below, t.last - t.below}:
            wanted = wanted | (
                (F.col("target") == i) & (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
            )
    for row in counted.where(wanted).collect():
        t = targets[row["target"]]
        for rank in (t.first, t.last):
            if row["upto"] - row["n"] <= rank - t.below < row["upto"]:
                out[(row["target"], rank)] = row["value"]
    return out

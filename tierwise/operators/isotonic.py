"""Monotone regression of outcomes on scores, pooled per score range and merged in a tree.

A block is a stretch of scores with one fitted value: the sum of outcomes over their number.
Adjacent blocks whose values do not rise are pooled (adjacent violators), and pooling the blocks of
pooled stretches gives the same result as pooling points, so every range of scores is pooled where
it lies, and a few ranges at a time are merged until one is left.  What meets in the last task are
blocks, not scores: of random outcomes about the cube root of the scores remain.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tierwise.functions.lineage import checkpointed

RANGES = 64  # score ranges that are pooled apart
MERGE = 8  # ranges that one task merges
MOST_BINS = 1024  # bins in which a score looks for its block
FEW_BLOCKS = 500_000  # blocks that are broadcast
_BLOCKS = "range long, low double, high double, pos double, n double"


def _pooled(low: np.ndarray, high: np.ndarray, pos: np.ndarray, n: np.ndarray) -> list[list[float]]:
    """Blocks of stretches in ascending order."""
    out: list[list[float]] = []
    for a, b, s, w in zip(low.tolist(), high.tolist(), pos.tolist(), n.tolist()):
        # Values are compared as products, so that equal ones are equal.
        while out and out[-1][2] * w >= s * out[-1][3]:
            last = out.pop()
            a, s, w = last[0], last[2] + s, last[3] + w
        out.append([a, b, s, w])
    return out


def _table(number: int, blocks: list[list[float]]) -> pa.Table:
    columns = list(zip(*blocks)) or [()] * 4
    return pa.table([pa.array(np.full(len(blocks), number)), *[pa.array(c, pa.float64()) for c in columns]], ["range", "low", "high", "pos", "n"])


def _pool_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, blocks = 0, []
    for batch in batches:
        if len(batch):
            number = batch.column("range")[0].as_py()
            p, pos, n = (batch.column(c).to_numpy() for c in ("p", "pos", "n"))
            held = [np.array([b[i] for b in blocks]) for i in range(4)]
            # Scores come in order, so what is pooled so far is only met at its end.
            blocks = _pooled(*[np.concatenate([h, x]) for h, x in zip(held, (p, p, pos, n))])
    if blocks:
        yield from _table(number, blocks).to_batches()


def _merge_ranges(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    table = table.sort_by("low")
    return _table(key[0].as_py(), _pooled(*[table.column(c).to_numpy() for c in ("low", "high", "pos", "n")]))


def isotonic_blocks(points: DataFrame, ranges: int = RANGES) -> DataFrame:
    """``low, high, value, weight`` of ascending blocks, from ``points(p, pos, n)``.

    ``pos`` sums the outcomes of ``n`` rows at a score.  Points without a score or without rows
    have no effect.
    """
    known = points.where("p is not null and n > 0").select(F.col("p").cast("double").alias("p"), "pos", "n")
    dealt = known.repartitionByRange(ranges, "p").sortWithinPartitions("p").withColumn("range", F.spark_partition_id().cast("long"))
    # Written once: the numbers of ranges must not change when a task is run again.
    blocks = checkpointed(dealt.mapInArrow(_pool_range, _BLOCKS))
    while ranges > 1:
        ranges = math.ceil(ranges / MERGE)
        into = F.floor(F.col("range") / MERGE).cast("long")
        blocks = blocks.withColumn("into", into).groupBy("into").applyInArrow(_merge_ranges, _BLOCKS)
    return blocks.select("low", "high", (F.col("pos") / F.col("n")).alias("value"), F.col("n").alias("weight"))


def predict_isotonic(scored: DataFrame, blocks: DataFrame, p: str = "p", out: str = "calibrated") -> DataFrame:
    """``scored`` with the value of each score's block in ``out``; null for a null score.

    Between two blocks the value is interpolated, and before the first and after the last it is
    theirs.  Blocks are dealt into about as many bins as a bin has blocks; a score finds its bin
    among their lower ends and its block inside.  Without blocks every value is null.
    """
    blocks = checkpointed(blocks.select("low", "high", "value"))
    m = blocks.count()
    if not m:
        return scored.withColumn(out, F.lit(None).cast("double"))
    bins = min(MOST_BINS, math.ceil(math.sqrt(m)))
    dealt = checkpointed(blocks.repartitionByRange(bins, "low").withColumn("bin", F.spark_partition_id()))
    one = F.struct("low", "high", "value")
    held = dealt.groupBy("bin").agg(F.array_sort(F.collect_list(one)).alias("held"), F.min("low").alias("_low"))
    held = checkpointed(held)
    edges = held.select("bin", "_low").orderBy("_low").collect()  # a row a bin
    number = {row["bin"]: i for i, row in enumerate(edges)}
    pairs = [F.lit(x) for pair in number.items() for x in pair]
    numbered = held.withColumn("_bin", F.create_map(*pairs)[F.col("bin")])
    # A bin ends with the first block of the next one.
    firsts = numbered.select((F.col("_bin") - 1).alias("_bin"), F.slice("held", 1, 1).alias("_next"))
    numbered = numbered.join(firsts, "_bin", "left").select("_bin", F.concat("held", F.coalesce("_next", F.slice("held", 1, 0))).alias("_held"))
    numbered = F.broadcast(numbered) if m <= FEW_BLOCKS else numbered
    score = F.col(f"`{p}`").cast("double")
    lows = F.array(*[F.lit(row["_low"]) for row in edges])
    rows = scored.withColumn("_bin", F.greatest(F.size(F.filter(lows, lambda e: e <= score)) - 1, F.lit(0)))
    rows = rows.join(numbered, "_bin", "left")
    at = F.greatest(F.size(F.filter("_held", lambda b: b["low"] <= score)) - 1, F.lit(0))
    own, after = F.get("_held", at), F.get("_held", at + 1)
    share = (score - own["high"]) / (after["low"] - own["high"])
    between = own["value"] + share * (after["value"] - own["value"])
    value = F.when((score > own["high"]) & after.isNotNull(), between).otherwise(own["value"])
    return rows.withColumn(out, F.when(score.isNotNull(), value)).drop("_bin", "_held")

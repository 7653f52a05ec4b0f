"""Interleaving of sources to target weights by proportionate-fair scheduling.

A cycle has as many slots as the whole-number weights add up to, and takes from each source as
many blocks as its weight, or what is left of it.  The k-th of n blocks in a cycle of L slots is
released at floor((k-1) L/n) and due at ceil(k L/n); the earliest due block among the released
ones takes each slot.  As the shares of a cycle add up to its length, every block lies inside its
window, so no source is ever a whole block ahead of or behind its share.  Cycles with equal
contents have equal schedules: there are at most two more than twice the sources, so a short fold
per kind of cycle is all that runs in order, and every row finds its slot by arithmetic and a join.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.functions.ranking import hash_rank
from tierwise.llm.frames import settled

#: Weights that are no whole numbers, or add up to more than MOST_SLOTS, are rounded to so many
#: slots a cycle: a cycle is scheduled by one fold.
RESOLUTION, MOST_SLOTS = 1000, 1 << 14
#: Slots of a schedule that are gathered before they are put aside.
STRETCH = 256
#: The schedule table has one row for each block of each kind of cycle and is broadcast up to here.
BROADCAST_ROWS = 1_000_000


def quotas(weights: Mapping[str | None, float], resolution: int = RESOLUTION) -> dict[str | None, int]:
    """Blocks of each source in a full cycle: whole weights without their common factor, up to
    MOST_SLOTS in all; others rounded by largest remainder, with one block at least."""
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")
    if all(float(w).is_integer() for w in weights.values()):
        whole = {s: int(w) for s, w in weights.items()}
        common = math.gcd(*whole.values()) if whole else 1
        if sum(whole.values()) // common <= MOST_SLOTS:
            return {s: w // common for s, w in whole.items()}
    total = sum(map(Fraction, weights.values()))
    exact = {s: Fraction(w) / total * resolution for s, w in weights.items()}
    out = {s: max(1, math.floor(x)) for s, x in exact.items()}
    order = sorted(exact, key=lambda s: (math.floor(exact[s]) - exact[s], str(s)))
    for s in order[: max(0, resolution - sum(out.values()))]:
        out[s] += 1
    return out


def _kinds(sizes: list[int], quota: list[int]) -> list[tuple[int, int, list[int]]]:
    """First cycle, first slot and blocks of each source, for each stretch of equal cycles."""
    ends = {n // q + extra for n, q in zip(sizes, quota) for extra in (0, 1)}
    out, slot = [], 0
    last = max((-(-n // q) for n, q in zip(sizes, quota)), default=0)
    begins = sorted({0, *ends} & set(range(last)))
    for begin, end in zip(begins, [*begins[1:], last]):
        blocks = [min(q, max(0, n - begin * q)) for n, q in zip(sizes, quota)]
        out.append((begin, slot, blocks))
        slot += (end - begin) * sum(blocks)
    return out


def _earliest_due(blocks: Column, length: Column) -> Column:
    """The slots of a cycle in order, as (source number, block number) from 0."""
    item = "struct<source:int,k:int>"
    start = F.struct(
        F.transform(blocks, lambda n: F.lit(0)).alias("taken"),
        F.array().cast(f"array<{item}>").alias("slots"),
        F.array().cast(f"array<array<{item}>>").alias("full"),
    )

    def written(state: Column, slot: Column) -> list[Column]:
        """The slots so far with one more; a full stretch is put aside, so that no step copies all."""
        slots = F.concat(state["slots"], F.array(slot))
        is_full = F.size(slots) >= STRETCH
        put_aside = F.when(is_full, F.concat(state["full"], F.array(slots))).otherwise(state["full"])
        return [F.when(is_full, F.slice(slots, 1, 0)).otherwise(slots).alias("slots"), put_aside.alias("full")]

    def take(state: Column, slot: Column) -> Column:
        def due(taken: Column, i: Column) -> Column:
            n = F.get(blocks, i)
            released = (taken < n) & (F.floor(taken.cast("long") * length / n) <= slot)
            return F.when(released, F.struct(F.ceil((taken + 1).cast("long") * length / n).alias("due"), i.alias("source")))

        # The choice stands in an array of one, so that it is made once and not at each use; the
        # slots so far stay outside, as elements of arrays are copied.
        chosen = F.array(F.array_min(F.filter(F.transform(state["taken"], due), lambda x: x.isNotNull()))["source"])
        following = F.element_at(
            F.transform(
                chosen,
                lambda first: F.struct(
                    F.transform(state["taken"], lambda t, i: t + F.when(i == first, 1).otherwise(0)).alias("taken"),
                    F.struct(first.alias("source"), F.get(state["taken"], first).alias("k")).alias("slot"),
                ),
            ),
            1,
        )
        return F.struct(following["taken"].alias("taken"), *written(state, following["slot"]))

    whole = lambda state: F.flatten(F.concat(state["full"], F.array(state["slots"])))
    return F.aggregate(F.sequence(F.lit(0), length - 1), start, take, whole)


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float],
    key: str = "doc_id",
    source: str = "source",
    block_rows: int = 1,
    seed: int = 0,
) -> DataFrame:
    """``key, source, block, slot, position`` for every row, none dropped or repeated.

    Rows of a source are shuffled by a hash of their key and cut into blocks of ``block_rows``;
    ``slot`` numbers the blocks of the mix, ``position`` the rows (slot x block_rows + place in the
    block, so only short last blocks leave gaps).  When a source is used up the others share its
    slots in proportion.  A source without a weight, null too, gets the least one given, or 1.
    Equal keys are ordered arbitrarily among themselves.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    # Rows are ranked inside hash slices, so a source with most of the rows is no single task.
    rows = hash_rank(docs.select(F.col(key).alias("_key"), F.col(source).alias("_source")), "_key", seed, "_rank", by=["_source"])
    rows = rows.withColumn("_block", F.floor((F.col("_rank") - 1) / block_rows))
    counts = {r["_source"]: r["count"] for r in docs.groupBy(F.col(source).alias("_source")).count().collect()}
    names = sorted(counts, key=lambda s: (s is not None, s))
    fallback = min(weights.values(), default=1)
    quota = quotas({s: weights.get(s, fallback) for s in names})
    number = {s: i for i, s in enumerate(names)}
    kinds = _kinds([-(-counts[s] // block_rows) for s in names], [quota[s] for s in names])
    if not kinds:
        kinds = [(0, 0, [])]
    table = spark.createDataFrame(
        [(i, blocks, sum(blocks)) for i, (_, _, blocks) in enumerate(kinds)], "kind int, blocks array<int>, length int"
    )
    slots = settled(table.where("length > 0"), slots=_earliest_due(F.col("blocks"), F.col("length")))
    slots = slots.select("kind", F.posexplode("slots").alias("at", "x"))
    slots = slots.select(
        F.col("kind").alias("_kind"), F.col("x.source").alias("_number"), F.col("x.k").cast("long").alias("_k"), F.col("at").alias("_at")
    )
    if sum(sum(blocks) for _, _, blocks in kinds) <= BROADCAST_ROWS:
        slots = F.broadcast(slots)
    named = spark.createDataFrame(
        [(s, number[s], quota[s]) for s in names], "_name string, _number int, _quota int"
    )  # one row a source
    rows = rows.join(F.broadcast(named), F.col("_source").cast("string").eqNullSafe(F.col("_name")))
    cycle = F.floor(F.col("_block") / F.col("_quota"))
    literal = lambda values: F.array(*[F.lit(int(v)) for v in values])
    begins = literal([k[0] for k in kinds])
    rows = rows.withColumn("_cycle", cycle).withColumn("_k", F.col("_block") - F.col("_cycle") * F.col("_quota"))
    rows = rows.withColumn("_kind", F.size(F.filter(begins, lambda b: b <= F.col("_cycle"))) - 1)
    placed = rows.join(slots, ["_kind", "_number", "_k"])
    slot = (
        F.get(literal([k[1] for k in kinds]), "_kind").cast("long")
        + (F.col("_cycle") - F.get(begins, "_kind")) * F.get(literal([sum(k[2]) for k in kinds]), "_kind")
        + F.col("_at")
    )
    return placed.withColumn("slot", slot).select(
        F.col("_key").alias(key),
        F.col("_source").alias(source),
        F.col("_block").cast("long").alias("block"),
        F.col("slot").cast("long"),
        (F.col("slot") * block_rows + (F.col("_rank") - 1) % block_rows).cast("long").alias("position"),
    )

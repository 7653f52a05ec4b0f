"""Approximate k-nearest-neighbour self-join by random hyperplanes.

Each of several tables hashes a vector to the sides of random planes through the mean of all
vectors.  A point looks into its own bucket of each table and into those that differ from it by
the planes it lies nearest to (multi-probe), so far fewer tables are needed.  Points are dealt by
key to parts of bounded size, and queries to slices; each slice meets each part once, with vectors
alone: codes of all tables are worked out there, and only the first of a part leave it.  A vector
travels once for each part as a query and once for each slice as a point, whatever the number of
tables and probes, so the shuffle grows as the input does while parts and slices are not full.
All candidates are compared exactly.

The exact join stays the default; ``lsh_recall`` holds a result against it on a seeded sample.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.functions.hashing import order_hash
from tierwise.functions.lineage import checkpointed
from tierwise.operators.neighbors import (
    CHUNK_PAIRS,
    GROUP_ROWS,
    _key_rank,
    _lists,
    _matrix,
    _nearest,
    _plain,
    _prepared,
    _without_self,
    nearest_neighbors,
)

TABLES = 16
PART_BYTES = 48 << 20  # vectors of a part of the points
MIN_SLICES = 8
SLICE_ROWS = 1 << 16  # queries of a slice
SLICE_CODES = 1 << 23  # codes that the queries of a slice look at in one table


@dataclass(frozen=True)
class Hashing:
    """``tables`` hashes of ``bits`` planes, and the buckets a point looks into in each."""

    tables: int
    bits: int
    probes: int
    seed: int = 0

    @classmethod
    def for_size(cls, size: int, tables: int = TABLES, seed: int = 0) -> Hashing:
        """Buckets become smaller with the table, so that comparisons grow with size^1.7."""
        bits = max(1, min(24, round(10 + 0.5 * math.log2(max(1, size) / 500))))
        return cls(tables, bits, max(1, min(2**bits, round(40 * 2 ** (0.4 * (bits - 10))))), seed)

    def planes(self, width: int) -> np.ndarray:
        return np.random.default_rng(self.seed).normal(size=(self.tables, max(1, width), self.bits))

    def codes(self, sides: np.ndarray) -> np.ndarray:
        return ((sides > 0).astype(np.int64) << np.arange(self.bits)).sum(axis=1)

    def nearby(self, sides: np.ndarray) -> np.ndarray:
        """The codes each row looks at: those that cross its nearest planes, by summed squared distance."""
        # Sets of ranks that can be among the best for any spacing come first by squared rank.
        sets = _cheapest(self.bits, 4 * self.probes)
        member = np.zeros((self.bits, len(sets)))
        for i, chosen in enumerate(sets):
            member[list(chosen), i] = 1.0
        most = min(self.probes, len(sets))
        out = np.empty((len(sides), most), np.int64)
        for begin in range(0, len(sides), 4096):
            own = sides[begin : begin + 4096]
            order = np.argsort(np.abs(own), axis=1)
            cost = np.take_along_axis(own * own, order, 1) @ member
            best = np.argpartition(cost, most - 1, axis=1)[:, :most]
            flips = np.take_along_axis((2.0**order) @ member, best, 1).astype(np.int64)
            out[begin : begin + 4096] = self.codes(own)[:, None] ^ flips
        return out


def _cheapest(bits: int, n: int) -> list[tuple[int, ...]]:
    """The ``n`` sets of ranks of least summed squared rank (from 1), the empty set first."""
    import heapq

    out: list[tuple[int, ...]] = [()]
    heap: list[tuple[int, tuple[int, ...]]] = [(1, (0,))] if bits else []
    while heap and len(out) < n:
        cost, chosen = heapq.heappop(heap)
        out.append(chosen)
        last = chosen[-1]
        if last + 1 < bits:
            # Move the last rank on, or add the next one.
            heapq.heappush(heap, (cost - (last + 1) ** 2 + (last + 2) ** 2, (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + (last + 2) ** 2, (*chosen, last + 1)))
    return out


def _hosts(points: DataFrame, key: str, vector: str, k: int, carry: Sequence[str], queries: Column | None, hashing: Hashing | None):
    """All rows, their types, their number, each different vector, the centre, and the hashing."""
    rows, shape, size, _, width, _ = _prepared(points, key, vector, k, carry, queries, False)
    hashing = hashing or Hashing.for_size(size)
    width = width or 0
    means = rows.agg(*[F.avg(F.get("vector", F.lit(i))).alias(f"m{i}") for i in range(width)]).first() if width else ()
    centre = np.array([m or 0.0 for m in means], dtype=float)
    copies = Window.partitionBy("vector").orderBy("key")
    hosts = rows.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1)
    asked = rows.where("is_query").select(F.col("vector").alias("_asked")).distinct()
    hosts = hosts.drop("is_query").join(asked, F.col("vector") == F.col("_asked"), "left")
    hosts = hosts.withColumn("is_query", (F.col("_copy") == 1) & F.col("_asked").isNotNull()).drop("_asked", "_copy")
    return rows, shape, size, checkpointed(hosts), centre, hashing


def _cells(size: int, width: int, hashing: Hashing) -> tuple[int, int]:
    """Parts of the points, and slices of the queries."""
    part = min(GROUP_ROWS, max(1, PART_BYTES // (8 * max(1, width))))
    slice_rows = max(1, min(part, SLICE_ROWS, SLICE_CODES // hashing.probes))
    return max(1, math.ceil(size / part)), max(MIN_SLICES, math.ceil(size / slice_rows))


class _Best:
    """The first k points of each query so far; pairs that several tables propose count once."""

    def __init__(self, q: np.ndarray, c: np.ndarray, rank: np.ndarray, k: int):
        self.q, self.c, self.rank, self.k = q, c, rank, k
        self.d2, self.at = np.full((len(q), k), np.inf), np.zeros((len(q), k), np.int64)
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.n = 0

    def propose(self, qi: np.ndarray, ci: np.ndarray) -> bool:
        """Whether enough pairs wait to be settled."""
        self.pending.append((qi, ci))
        self.n += len(qi)
        return self.n >= 4 * CHUNK_PAIRS

    def settle(self) -> np.ndarray:
        """Sums the distances of waiting pairs exactly; the queries whose lists were looked at."""
        if not self.n:
            return np.zeros(0, np.int64)
        qi, ci = (np.concatenate(x) for x in zip(*self.pending))
        self.pending, self.n = [], 0
        d2 = np.zeros(len(qi))
        for i in range(0, len(qi), CHUNK_PAIRS):
            part = slice(i, i + CHUNK_PAIRS)
            gap = self.q[qi[part]] - self.c[ci[part]]
            gap *= gap
            for j in range(self.c.shape[1]):
                d2[part] += gap[:, j]
        keep = d2 <= self.d2[qi, -1]
        qi, ci, d2 = qi[keep], ci[keep], d2[keep]
        some = np.unique(qi)
        row, slot = np.nonzero(np.isfinite(self.d2[some]))
        qi = np.concatenate([qi, some[row]])
        ci, d2 = np.concatenate([ci, self.at[some[row], slot]]), np.concatenate([d2, self.d2[some[row], slot]])
        order = np.lexsort((self.rank[ci], d2, qi))
        qi, ci, d2 = qi[order], ci[order], d2[order]
        new = np.ones(len(qi), bool)
        new[1:] = (qi[1:] != qi[:-1]) | (ci[1:] != ci[:-1])
        qi, ci, d2 = qi[new], ci[new], d2[new]
        slot = np.arange(len(qi)) - np.searchsorted(qi, qi)
        first = slot < self.k
        qi, ci, d2, slot = qi[first], ci[first], d2[first], slot[first]
        self.d2[some] = np.inf
        self.d2[qi, slot], self.at[qi, slot] = d2, ci
        return some


def _search(shape, hashing: Hashing, centre: np.ndarray, k: int):
    """Answers the queries of a slice from the points of a part, bucket by bucket of each table."""
    planes = hashing.planes(len(centre))

    def answer(visitors: pa.Table, hosts: pa.Table) -> pa.Table:
        visitors = _plain(visitors.rename_columns([c.removeprefix("q_") for c in visitors.column_names]))
        hosts = _plain(hosts)
        q, c, rank, n = _matrix(visitors), _matrix(hosts), _key_rank(hosts), len(visitors)
        if not n or not len(hosts):
            nothing = np.zeros(0, np.int64)
            found = _lists(shape, hosts, nothing, nothing, np.zeros(0), n)
            return pa.table([visitors.column("key"), found], names=["key", "neighbors"])
        best = _Best(q, c, rank, k)
        own, other = q - centre, c - centre
        a2, c2 = np.einsum("ij,ij->i", own, own), np.einsum("ij,ij->i", other, other)
        # As in the exact join: a product proposes within its rounding error, exact sums decide.
        kind = np.float32 if max(a2.max(), c2.max()) < 1e30 else np.float64
        slack = 16.0 * (c.shape[1] + 4) * np.finfo(kind).eps * (a2 + c2.max())
        left = np.column_stack([-2.0 * own, np.ones(n)]).astype(kind)
        right = np.column_stack([other, c2]).astype(kind)
        limit = np.full(n, np.inf, kind)

        def settle() -> None:
            some = best.settle()
            limit[some] = best.d2[some, -1] - a2[some] + slack[some]

        for plane in planes:
            code, order = _ordered(hashing.codes(other @ plane))
            codes, starts = np.unique(code, return_index=True)
            ends, side = np.append(starts[1:], len(code)), right[order]
            number = np.full(1 << hashing.bits, -1, np.int32)
            number[codes] = np.arange(len(codes))
            looks = number[hashing.nearby(own @ plane)]
            probes = looks.shape[1]
            there = np.flatnonzero(looks >= 0)
            bucket, by = _ordered(looks.reshape(-1)[there])
            who = there[by] // probes
            used, begin = np.unique(bucket, return_index=True)
            for b, s, e in zip(used.tolist(), begin.tolist(), [*begin[1:].tolist(), len(bucket)]):
                low, high, some = starts[b], ends[b], who[s:e]
                if (high - low) * (e - s) > CHUNK_PAIRS:
                    # So many pairs are cut to the first of each query here.
                    settle()
                    held = order[low:high]
                    qi, ci, _ = _nearest(q[some], c[held], rank[held], k, best.d2[some, -1])
                    best.propose(some[qi], held[ci])
                    settle()
                    continue
                near = np.flatnonzero(left[some] @ side[low:high].T <= limit[some][:, None])
                if len(near):
                    qi, ci = np.divmod(near, high - low)
                    if best.propose(some[qi], order[low + ci]):
                        settle()
            settle()
        held = np.isfinite(best.d2)
        qi = np.repeat(np.arange(n), held.sum(axis=1))
        found = _lists(shape, hosts, qi, best.at[held], best.d2[held], n)
        return pa.table([visitors.column("key"), found], names=["key", "neighbors"])

    return answer


def _ordered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values sorted, and their order; few different ones by a radix sort."""
    order = np.argsort(values.astype(np.uint16) if not len(values) or values.max() < 1 << 16 else values, kind="stable")
    return values[order], order


def nearest_neighbors_lsh(
    points: DataFrame,
    key: str,
    vector: str,
    k: int,
    carry: Sequence[str] = (),
    queries: Column | None = None,
    hashing: Hashing | None = None,
) -> DataFrame:
    """As ``nearest_neighbors``, but a neighbour is only found if a bucket is shared.

    Distances and order of what is found are exact, and a point that meets fewer than k others has
    a shorter list.  Of equal vectors the k+1 smallest keys are hashed and the rest share their
    answer, so a crowd of copies is no crowded bucket.
    """
    rows, shape, size, hosts, centre, hashing = _hosts(points, key, vector, k, carry, queries, hashing)
    parts, slices = _cells(size, len(centre), hashing)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n, salt: F.pmod(F.xxhash64("key", F.lit(salt)), F.lit(n)).cast("int")
    held = hosts.select("key", "vector", *shape.carry, dealt(parts, 1).alias("part")).withColumn("slice", every(slices))
    # Both sides come from one table, so the visitors' columns get names of their own.
    asked = hosts.where("is_query").select("key", "vector", dealt(slices, 2).alias("q_slice")).withColumn("q_part", every(parts))
    met = (
        asked.withColumnsRenamed({"key": "q_key", "vector": "q_vector"})
        .groupBy("q_part", "q_slice")
        .cogroup(held.groupBy("part", "slice"))
        .applyInArrow(_search(shape, hashing, centre, k + 1), shape.partial)
    )
    best = Window.partitionBy("key").orderBy("_n.d2", "_n.key")
    merged = (
        met.select("key", F.explode("neighbors").alias("_n"))
        .withColumn("_at", F.row_number().over(best))
        .where(F.col("_at") <= k + 1)
        .groupBy(F.col("key").alias("_rep"))
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_n"))), lambda e: e["_n"]).alias("neighbors"))
    )
    heads = hosts.where("is_query").select("key", F.col("vector").alias("_vector"))
    by_vector = heads.join(merged, F.col("key") == F.col("_rep")).select("_vector", "neighbors")
    found = rows.where("is_query").drop("is_query").join(by_vector, F.col("vector") == F.col("_vector"))
    return _without_self(found.select("key", "vector", *shape.carry, "neighbors"), key, vector, k)


def _counted(hashing: Hashing, centre: np.ndarray):
    """How many points of a batch have each code, and how many queries look at it, by table."""
    planes = hashing.planes(len(centre))

    def run(batches):
        for batch in batches:
            table = _plain(pa.Table.from_batches([batch]))
            if not len(table):
                continue
            x, asked = _matrix(table) - centre, table.column("is_query").to_numpy()
            for t, plane in enumerate(planes):
                sides = x @ plane
                held, hosts = np.unique(hashing.codes(sides), return_counts=True)
                seen, looks = np.unique(hashing.nearby(sides[asked]), return_counts=True)
                columns = [
                    pa.array(np.full(len(held) + len(seen), t, np.int32)),
                    pa.array(np.concatenate([held, seen])),
                    pa.array(np.concatenate([hosts, np.zeros(len(seen), np.int64)])),
                    pa.array(np.concatenate([np.zeros(len(held), np.int64), looks])),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["table", "code", "hosts", "looks"])

    return run


def lsh_comparisons(points: DataFrame, key: str, vector: str, k: int, hashing: Hashing | None = None) -> int:
    """Distances that ``nearest_neighbors_lsh`` works out, from counts of its buckets."""
    _, _, _, hosts, centre, hashing = _hosts(points, key, vector, k, (), None, hashing)
    counts = hosts.select("vector", "is_query").mapInArrow(_counted(hashing, centre), "table int, code long, hosts long, looks long")
    each = counts.groupBy("table", "code").agg(F.sum("hosts").alias("hosts"), F.sum("looks").alias("looks"))
    return each.agg(F.sum(F.col("hosts") * F.col("looks"))).first()[0] or 0


def lsh_recall(points: DataFrame, found: DataFrame, key: str, vector: str, k: int, n: int = 200, seed: int = 0) -> DataFrame:
    """``key, n_exact, n_found, recall`` for the ``n`` points that come first in a seeded hash order.

    The exact neighbours come from ``nearest_neighbors``, for which so few queries are one scan.
    """
    sample = points.select(key).orderBy(order_hash(F.col(key), seed), key).limit(n)
    sample = checkpointed(sample.withColumn("_asked", F.lit(True)))
    rows = points.select(key, vector).join(F.broadcast(sample), key, "left")  # n rows
    exact = nearest_neighbors(rows, key, vector, k, queries=F.col("_asked"))
    keys = lambda c: F.transform(c, lambda x: x["key"])
    both = exact.select(key, keys("neighbors").alias("_exact")).join(found.select(key, keys("neighbors").alias("_found")), key, "left")
    hits = F.size(F.array_intersect("_exact", F.coalesce("_found", F.array().cast(found.schema["neighbors"].dataType.elementType["key"].dataType.simpleString().join(("array<", ">"))))))
    return both.select(key, F.size("_exact").alias("n_exact"), hits.alias("n_found")).withColumn(
        "recall", F.when(F.col("n_exact") > 0, F.col("n_found") / F.col("n_exact"))
    )

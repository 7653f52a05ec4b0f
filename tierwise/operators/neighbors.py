"""Exact k-nearest-neighbour self-join.

Up to two blocks of points are answered by one task.  Few queries against many points are sent to
every task instead: one scan keeps the best of each query and task, and the lists of tasks are
merged in a tree, so the points are never shuffled.  Beyond that:

1. Of equal vectors only the k+1 smallest keys can ever be neighbours, so the rest are set
   aside and share the answer of their vector at the end.  Digests tell which vectors can be
   equal; the others are not shuffled for it, and all find their answers by key.
2. Every point goes to its nearest pivot, and points are cut by counted ranks into blocks
   of bounded size along (pivot, distance to pivot): a crowded cell becomes many blocks.
3. Each block answers its own points; the distance to the last neighbour found bounds what
   is still missing.  Triangle and half-space bounds (Lu et al. 2012) name the other
   blocks that can hold anything closer, and points visit those alone.
4. Neighbouring blocks form groups of bounded size.  A point travels once to each group that
   holds a block it must visit, with the numbers of those blocks, and its bound shrinks from
   block to block.  Visitors of a group are spread over slices, each with a copy of the group.

No task sees more than a group and an equal share of visitors, and only the best k+1 of a
group leave it, never pairs.  Where the bounds rule out nothing, each vector is shuffled
about twice per group, not per block, and three times besides, in single precision where that
changes no number.  There are MIN_GROUPS groups until they are full, so up to MIN_GROUPS *
GROUP_BYTES of vectors the shuffle grows as the input does; distances are all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tierwise.functions.hashing import order_hash
from tierwise.functions.lineage import checkpointed
from tierwise.functions.sizes import BROADCAST_BYTES

BLOCK_ROWS = 2048
MAX_BLOCKS = 1_000_000  # bounds the block table every task reads; blocks grow beyond it
MAX_PIVOTS = 1024
MANY_BLOCKS = 256  # blocks asked for smaller than BLOCK_ROWS grow with the table from here on
GROUP_BYTES = 64 << 20  # vectors of a group of blocks
GROUP_ROWS = 128 << 10  # rows of a group, however short their vectors
MIN_GROUPS = 5  # where there are as many blocks: each is met by as many slices of visitors
CHUNK_CELLS = 1_000_000  # query x candidate distances held at a time
CHUNK_PAIRS = 65_536  # proposed pairs whose exact distances are summed at a time
FEW_BYTES = 16 << 20  # vectors of queries that are sent to every task
SLICE_QUERIES = 4096  # queries whose lists are worked on at a time
VISIT_ROWS = 16_384  # visitors that are answered at a time
MERGE = 16  # lists of a query that one row of the merging tree takes
DIGEST_BYTES = 16  # a digest that is broadcast


def nearest_neighbors(
    points: DataFrame,
    key: str,
    vector: str,
    k: int,
    carry: Sequence[str] = (),
    queries: Column | None = None,
    with_vectors: bool = False,
    block_rows: int = BLOCK_ROWS,
    few_bytes: int = FEW_BYTES,
) -> DataFrame:
    """The k nearest other points of every point (or of those matching ``queries``).

    Adds ``neighbors``: array of ``(d2, key, carried columns[, vector])`` ordered by squared
    distance, then key.  Only ``key``, ``vector`` and ``carry`` are kept of the input.  Of a large
    table, queries whose vectors and lists were measured to take up to ``few_bytes`` are sent to
    every task.
    """
    rows, shape, size, asked, width, single = _prepared(points, key, vector, k, carry, queries, with_vectors)
    per_query = 8 * (max(1, width or 0) * (1 + (k + 1) * with_vectors) + 4 * (k + 1))
    if size > 2 * block_rows and queries is not None and asked * per_query <= few_bytes:
        found = _few_queries(rows, shape, k + 1)
    elif size <= 2 * block_rows:
        block = rows.withColumn("block", F.lit(0)).groupBy("block")
        found = block.applyInArrow(_within(shape, k + 1), shape.answer)
        found = found.select("key", "vector", *carry, "neighbors")
    else:
        found = _by_blocks(rows, shape, k + 1, size, asked, block_rows, width, single)
    return _without_self(found, key, vector, k)


def _prepared(points: DataFrame, key: str, vector: str, k: int, carry: Sequence[str], queries: Column | None, with_vectors: bool):
    """Rows ``key, vector, carried, is_query``, their types, the counts of rows, queries and numbers,
    and whether single precision holds every number as it is."""
    if k < 1:
        raise ValueError("k must be at least 1")
    is_query = F.lit(True) if queries is None else F.coalesce(queries, F.lit(False))
    rows = points.select(
        F.col(key).alias("key"),
        F.col(vector).cast("array<double>").alias("vector"),
        *carry,
        is_query.alias("is_query"),
    )
    lengths = rows.agg(
        F.count(F.lit(1)),
        F.count_if("is_query"),
        F.count_if(F.col("vector").isNull() | F.exists("vector", lambda v: v.isNull())),
        F.min(F.size("vector")),
        F.max(F.size("vector")),
        F.count_if(F.exists("vector", lambda v: v.cast("float").cast("double") != v)),
    ).first()
    size, asked, bad, shortest, width, double = lengths
    if bad or shortest != width:
        raise ValueError("every vector must be present, of one length and without nulls")
    return rows, _Shape(rows.schema, list(carry), with_vectors), size, asked, width, not double


def _without_self(found: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    others = F.filter("neighbors", lambda n: n["key"] != F.col("key"))
    return found.withColumn("neighbors", F.slice(others, 1, k)).withColumnsRenamed(
        {"key": key, "vector": vector}
    )


def knn_pairs(neighbors: DataFrame, key: str) -> DataFrame:
    """One row per neighbour: ``i``, ``j``, ``rank`` and ``d2``."""
    return neighbors.select(
        F.col(key).alias("i"), F.posexplode("neighbors").alias("_at", "_n")
    ).select("i", F.col("_n.key").alias("j"), (F.col("_at") + 1).alias("rank"), F.col("_n.d2").alias("d2"))


class _Shape:
    """Row types that travel between Spark and the block kernels."""

    def __init__(self, schema: T.StructType, carry: list[str], with_vectors: bool):
        self.carry, self.with_vectors = carry, with_vectors
        self.vector = T.StructField("vector", T.ArrayType(T.DoubleType(), True))
        schema = T.StructType([self.vector if f.name == "vector" else f for f in schema])
        kept = ["key", *carry, *(["vector"] if with_vectors else [])]
        item = T.StructType([T.StructField("d2", T.DoubleType()), *[schema[c] for c in kept]])
        self.neighbors = T.StructField("neighbors", T.ArrayType(item))
        base = [schema["key"], schema["vector"], *[schema[c] for c in carry]]
        self.answer = T.StructType([*base, self.neighbors])
        visit = T.StructType(
            [T.StructField("group", T.IntegerType()), T.StructField("blocks", T.ArrayType(T.IntegerType()))]
        )
        self.local = T.StructType(
            [
                schema["key"],
                schema["vector"],
                self.neighbors,
                T.StructField("bound", T.DoubleType()),
                T.StructField("visit", T.ArrayType(visit)),
            ]
        )
        self.partial = T.StructType([schema["key"], self.neighbors])


def _plain(table: pa.Table) -> pa.Table:
    """The table with vectors of nullable elements, as the declared results have them."""
    at = table.schema.get_field_index("vector")
    return table.set_column(at, "vector", table.column("vector").cast(pa.list_(pa.float64())))


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _matrix(table: pa.Table, name: str = "vector") -> np.ndarray:
    column = _whole(table.column(name))
    if len(column) == 0:
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _nearest(
    q: np.ndarray, c: np.ndarray, rank: np.ndarray, k: int, bound: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query index, candidate index and squared distance of the k best per query.

    A matrix product proposes candidates within its own rounding error, in single precision
    unless that proposes too many; their distances are then summed exactly as written, so ties
    and order do not depend on blocking.
    """
    if not len(q) or not len(c):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(0)
    centre = c.mean(axis=0)
    cc = c - centre
    c2 = np.einsum("ij,ij->i", cc, cc)
    kk, most = min(k, len(c)), c2.max()
    # The product with (-2a, 1) is the squared distance less that of the query.
    sides = {kind: np.column_stack([cc, c2]).astype(kind).T for kind in ((np.float32, np.float64) if most < 1e30 else (np.float64,))}
    out = []
    step = max(1, CHUNK_CELLS // len(c))
    for s in range(0, len(q), step):
        a = q[s : s + step] - centre
        a2 = np.einsum("ij,ij->i", a, a)
        own = np.column_stack([-2.0 * a, np.ones(len(a))])
        for kind, side in sides.items():
            if kind is np.float32 and not a2.max() < 1e30:
                continue
            rough = own.astype(kind) @ side
            limit = np.full(len(a), np.inf) if bound is None else bound[s : s + step] - a2
            if np.isinf(limit).any():
                limit = np.minimum(limit, np.partition(rough, kk - 1, axis=1)[:, kk - 1])
            slack = 16.0 * (c.shape[1] + 4) * np.finfo(kind).eps * (a2 + most)
            at = np.flatnonzero(rough <= (limit + slack).astype(kind)[:, None])
            if kind is np.float64 or len(at) <= 4 * k * len(a) + rough.size // 64:
                break
        qi, ci = np.divmod(at, len(c))
        d2 = np.zeros(len(qi))
        for i in range(0, len(qi), CHUNK_PAIRS):
            part = slice(i, i + CHUNK_PAIRS)
            gap = q[s + qi[part]] - c[ci[part]]
            gap *= gap
            for j in range(c.shape[1]):
                d2[part] += gap[:, j]
        if bound is not None:
            keep = d2 <= bound[s + qi]
            qi, ci, d2 = qi[keep], ci[keep], d2[keep]
        order = np.lexsort((rank[ci], d2, qi))
        qi, ci, d2 = qi[order], ci[order], d2[order]
        first = np.searchsorted(qi, qi, side="left")
        best = np.arange(len(qi)) - first < k
        out.append((s + qi[best], ci[best], d2[best]))
    return tuple(np.concatenate(parts) for parts in zip(*out))


def _key_rank(table: pa.Table) -> np.ndarray:
    keys = table.column("key").to_numpy()
    rank = np.empty(len(keys), dtype=np.int64)
    rank[np.argsort(keys, kind="stable")] = np.arange(len(keys))
    return rank


def _lists(shape: _Shape, candidates: pa.Table, qi, ci, d2, n_queries: int) -> pa.Array:
    """Neighbour lists, one per query, as an Arrow list of structs."""
    offsets = np.searchsorted(qi, np.arange(n_queries + 1)).astype(np.int32)
    kept = ["key", *shape.carry, *(["vector"] if shape.with_vectors else [])]
    picked = candidates.select(kept).take(pa.array(ci))
    arrays = [pa.array(d2), *[_whole(picked.column(name)) for name in kept]]
    items = pa.StructArray.from_arrays(arrays, names=["d2", *kept])
    return pa.ListArray.from_arrays(pa.array(offsets), items)


def _within(shape: _Shape, k: int):
    def answer(table: pa.Table) -> pa.Table:
        table = _plain(table)
        asked = table.filter(table.column("is_query"))
        qi, ci, d2 = _nearest(_matrix(asked), _matrix(table), _key_rank(table), k)
        lists = _lists(shape, table, qi, ci, d2, len(asked))
        return asked.select(["key", "vector", *shape.carry]).append_column("neighbors", lists)

    return answer


# ---------------------------------------------------------------- few queries


def _few_queries(rows: DataFrame, shape: _Shape, k: int) -> DataFrame:
    """Every task scans its points once for all queries, which were measured to be few."""
    spark = rows.sparkSession
    asked = rows.where("is_query").drop("is_query").toArrow()
    number = pa.array(np.arange(len(asked)))
    queries = spark.createDataFrame(asked.append_column("_q", number))
    partial = T.StructType([T.StructField("_q", T.LongType()), T.StructField("_part", T.LongType()), shape.neighbors])
    best = rows.drop("is_query").mapInArrow(_scan_for(shape, _matrix(_plain(asked)), k), partial)
    parts = rows.rdd.getNumPartitions()
    merged = F.slice(F.array_sort(F.flatten(F.collect_list("neighbors"))), 1, k).alias("neighbors")
    while parts > 1:
        parts = -(-parts // MERGE)
        best = best.groupBy("_q", F.floor(F.col("_part") / MERGE).alias("_part")).agg(merged)
    return queries.join(F.broadcast(best.select("_q", "neighbors")), "_q").drop("_q")  # a row a query


def _scan_for(shape: _Shape, q: np.ndarray, k: int):
    from pyspark import TaskContext

    kept = ["key", *shape.carry, *(["vector"] if shape.with_vectors else [])]

    def scan(batches):
        part = TaskContext.get().partitionId()
        # The lists of all queries stay; what is worked on beside them are those of one slice.
        slices = [_Held(s, q[s : s + SLICE_QUERIES], k) for s in range(0, len(q), SLICE_QUERIES)]
        for batch in batches:
            table = _plain(pa.Table.from_batches([batch]))
            if len(table):
                x, rank, own = _matrix(table), _key_rank(table), table.select(kept)
                for held in slices:
                    held.meet(x, rank, own)
        for held in slices:
            if held.rows is not None:
                lists = _lists(shape, held.rows, held.owner, np.arange(len(held.owner)), held.best, len(held.q))
                numbers = held.start + np.arange(len(held.q))
                columns = [pa.array(numbers), pa.array(np.full(len(held.q), part)), lists]
                yield pa.RecordBatch.from_arrays(columns, ["_q", "_part", "neighbors"])

    return scan


class _Held:
    """The best ``k`` so far of some queries, whose numbers begin at ``start``."""

    def __init__(self, start: int, q: np.ndarray, k: int):
        self.start, self.q, self.k = start, q, k
        self.rows, self.owner, self.best = None, np.zeros(0, np.int64), np.zeros(0)
        self.bound = np.full(len(q), np.inf)

    def meet(self, x: np.ndarray, rank: np.ndarray, table: pa.Table) -> None:
        qi, ci, d2 = _nearest(self.q, x, rank, self.k, self.bound)
        if not len(qi):
            return
        found = table.take(pa.array(ci))
        # The lists so far and the batch's, cut to the first k of each query again.
        rows = found if self.rows is None else pa.concat_tables([self.rows, found])
        owner, best = np.concatenate([self.owner, qi]), np.concatenate([self.best, d2])
        order = np.lexsort((_key_rank(rows), best, owner))
        owner, best = owner[order], best[order]
        first = np.arange(len(owner)) - np.searchsorted(owner, owner) < self.k
        self.rows, self.owner, self.best = rows.take(pa.array(order[first])), owner[first], best[first]
        ends = np.searchsorted(self.owner, np.arange(len(self.q)), "right") - 1
        full = np.bincount(self.owner, minlength=len(self.q)) >= self.k
        self.bound[full] = self.best[ends[full]]


# ---------------------------------------------------------------- many blocks


def _layout(size: int, block_rows: int, width: int) -> tuple[int, int, int]:
    """Rows of a block, the number of blocks, and how many of them are a group."""
    block_rows = max(block_rows, min(BLOCK_ROWS, math.ceil(size / MANY_BLOCKS)), math.ceil(size / MAX_BLOCKS))
    n_blocks = math.ceil(size / block_rows)
    return block_rows, n_blocks, _in_group(n_blocks, block_rows, width)


def _in_group(n_blocks: int, block_rows: int, width: int) -> int:
    group_rows = min(GROUP_ROWS, GROUP_BYTES // (8 * max(1, width)))
    return max(1, min(group_rows // block_rows, math.ceil(n_blocks / MIN_GROUPS)))


def _by_blocks(
    rows: DataFrame, shape: _Shape, k: int, size: int, asked: int, block_rows: int, width: int, single: bool
) -> DataFrame:
    block_rows, n_blocks, in_group = _layout(size, block_rows, width)
    points, twins = _one_of_equals(rows, k, asked == size)
    pivots = _pivots(rows, min(MAX_PIVOTS, 2 * n_blocks))
    placed = points.mapInArrow(
        _place(pivots),
        T.StructType(
            [
                *[shape.vector if f.name == "vector" else f for f in points.schema],
                T.StructField("cell", T.IntegerType()),
                T.StructField("reach", T.DoubleType()),
            ]
        ),
    )
    # Vectors travel in single precision where it holds them; kernels read them as doubles again.
    sent = F.col("vector").cast("array<float>" if single else "array<double>")
    placed = placed.withColumn("vector", sent)
    ranged = placed.repartitionByRange(math.ceil(n_blocks / in_group), "cell", "reach", "key")
    ranged = ranged.sortWithinPartitions("cell", "reach", "key")
    # Written once: numbers must not change when a task is run again.  They hold partition and place in it.
    parts = checkpointed(ranged.withColumn("_at", F.monotonically_increasing_id()))
    parts = parts.withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.groupBy("_part").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block_rows))).alias("_n"))
    first = first.select("_part", "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    first = checkpointed(first)  # a row per part
    # Parts end within a block, so there are some more blocks than full ones would be.
    n_blocks = first.agg(F.sum("_n")).first()[0]
    in_group = _in_group(n_blocks, block_rows, width)
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    number = F.col("_first") + F.floor(place / F.lit(float(block_rows)))
    blocks = (
        parts.join(F.broadcast(first.drop("_n")), "_part")
        .withColumn("block", number.cast("int"))
        .withColumn("group", F.floor(F.col("block") / F.lit(float(in_group))).cast("int"))
        .drop("_part", "_at", "_first")
    )

    spans = blocks.groupBy("block", "cell").agg(F.min("reach").alias("low"), F.max("reach").alias("high"))
    # At most one row per block and per pivot.
    spans = spans.orderBy("cell", "block").toPandas().to_numpy(dtype=float)

    local = blocks.groupBy("block").applyInArrow(_local(shape, k, pivots, spans, in_group), shape.local)
    local = checkpointed(local.withColumn("vector", sent))
    visits = local.select("key", "vector", "bound", F.explode("visit").alias("_v")).select(
        "key", "vector", "bound", "_v.group", "_v.blocks"
    )
    slices = visits.groupBy("group").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(float(block_rows * in_group))).cast("int").alias("slices")
    )
    slices = F.broadcast(slices)  # one row per group, MAX_BLOCKS at most
    visitors = visits.join(slices, "group").withColumn("slice", F.pmod(F.xxhash64("key"), F.col("slices")).cast("int"))
    hosts = (
        blocks.select("key", "vector", *shape.carry, "block", "group")
        .join(slices, "group")
        .repartition(F.col("key"))  # spreads the copying of popular groups
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    )
    abroad = (
        visitors.drop("slices")
        .groupBy("group", "slice")
        .cogroup(hosts.drop("slices").groupBy("group", "slice"))
        .applyInArrow(_visit(shape, k), shape.partial)
    )
    near = local.select("key", "neighbors").unionByName(abroad)
    # A list travels whole, one row for each group that was visited.
    best = F.slice(F.array_sort(F.flatten(F.collect_list("neighbors"))), 1, k).alias("neighbors")
    merged = near.repartition(F.col("key")).groupBy(F.col("key").alias("_rep")).agg(best)
    answered = rows.where("is_query").drop("is_query").withColumn("_of", F.col("key"))
    if twins is not None:
        answered = answered.drop("_of").join(twins, F.col("key") == F.col("_twin"), "left")
        answered = answered.withColumn("_of", F.coalesce("_first_key", "key")).drop("_twin", "_first_key")
    return answered.join(merged, F.col("_of") == F.col("_rep")).select("key", "vector", *shape.carry, "neighbors")


def _one_of_equals(rows: DataFrame, k: int, all_asked: bool) -> tuple[DataFrame, DataFrame | None]:
    """The k smallest keys of every vector, of which the first is asked if any row of the vector is.

    With them, for every other row of a vector its first key, as ``_twin, _first_key``; None if no
    vector is there twice.
    """
    # A digest of minus zero would be that of zero anyway; windows and joins take them for equal.
    digest = F.xxhash64(F.transform("vector", lambda v: v + F.lit(0.0)))
    repeated = rows.groupBy(digest.alias("_digest")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    repeated = checkpointed(repeated.select("_digest"))
    count = repeated.count()
    if not count:
        return rows, None
    single, several = None, rows
    if count * DIGEST_BYTES <= BROADCAST_BYTES:
        marked = rows.join(F.broadcast(repeated), digest == F.col("_digest"), "left")
        single = marked.where(F.col("_digest").isNull()).drop("_digest")
        several = marked.where(F.col("_digest").isNotNull()).drop("_digest")
    equal = Window.partitionBy("vector").orderBy("key")
    all_equal = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = several.withColumns(
        {
            "_copy": F.row_number().over(equal),
            "_first_key": F.first("key").over(equal),
            "_any": F.lit(True) if all_asked else F.max("is_query").over(all_equal),
        }
    )
    kept = numbered.where(F.col("_copy") <= k).withColumn("is_query", (F.col("_copy") == 1) & F.col("_any"))
    kept = kept.select(*rows.columns)
    twins = numbered.where(F.col("_copy") > 1).select(F.col("key").alias("_twin"), "_first_key")
    return kept if single is None else single.unionByName(kept), twins


def _pivots(rows: DataFrame, count: int) -> np.ndarray:
    """Reference points drawn by hash of the key; at most MAX_PIVOTS rows."""
    drawn = rows.select("vector", order_hash(F.col("key"), 0).alias("_h"), "key").orderBy("_h", "key").limit(count)
    vectors = drawn.select("vector").toPandas()["vector"]
    return np.unique(np.stack(vectors.to_numpy()), axis=0)


def _to_pivots(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances to all pivots by one product, and how far the squares of a row may be off."""
    centre = pivots.mean(axis=0)
    a, p = x - centre, pivots - centre
    a2, p2 = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", p, p)
    error = 8.0 * (x.shape[1] + 4) * np.finfo(np.float64).eps * (a2 + p2.max())
    if not np.isfinite(error).all():
        return _to_pivots_directly(x, pivots), np.zeros(len(x))
    gaps = a @ (-2.0 * p.T)
    gaps += a2[:, None]
    gaps += p2
    return np.sqrt(np.maximum(gaps, 0.0, out=gaps), out=gaps), error


def _to_pivots_directly(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    gaps = np.empty((len(x), len(pivots)))
    step = max(1, CHUNK_CELLS // max(1, len(pivots) * x.shape[1] if x.size else 1))
    for s in range(0, len(x), step):
        diff = x[s : s + step, None, :] - pivots[None, :, :]
        gaps[s : s + step] = np.sqrt(np.einsum("ijk,ijk->ij", diff, diff))
    return gaps


def _nearest_pivot(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest pivot and the distance to it; where the product leaves doubt, both as written."""
    cell, reach = np.empty(len(x), dtype=np.int64), np.empty(len(x))
    step = max(1, CHUNK_CELLS // len(pivots))
    for s in range(0, len(x), step):
        part = x[s : s + step]
        gaps, error = _to_pivots(part, pivots)
        own = gaps.argmin(axis=1)
        best = gaps[np.arange(len(part)), own]
        unsure = np.flatnonzero(np.count_nonzero(gaps <= np.sqrt(best * best + 2.0 * error)[:, None], axis=1) > 1)
        own[unsure] = _to_pivots_directly(part[unsure], pivots).argmin(axis=1)
        diff = part - pivots[own]
        cell[s : s + step], reach[s : s + step] = own, np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return cell, reach


def _place(pivots: np.ndarray):
    def place(batches):
        for batch in batches:
            table = _plain(pa.Table.from_batches([batch]))
            x = _matrix(table)
            if not len(x):
                continue
            cell, reach = _nearest_pivot(x, pivots)
            table = table.append_column("cell", pa.array(cell.astype(np.int32)))
            table = table.append_column("reach", pa.array(reach))
            yield from table.to_batches()

    return place


def _local(shape: _Shape, k: int, pivots: np.ndarray, spans: np.ndarray, in_group: int):
    """Answer a block's own points and name the other blocks they must visit."""
    spans = spans[np.lexsort((spans[:, 1], spans[:, 0]))]
    span_cell, low, high = spans[:, 1].astype(np.int64), spans[:, 2], spans[:, 3]
    n_blocks = int(spans[-1, 0]) + 1
    starts = np.searchsorted(spans[:, 0], np.arange(n_blocks))
    pivot_gaps = _to_pivots_directly(pivots, pivots)

    def answer(table: pa.Table) -> pa.Table:
        table = _plain(table)
        home = table.column("block")[0].as_py()
        asked = table.filter(table.column("is_query"))
        n = len(asked)
        qi, ci, d2 = _nearest(_matrix(asked), _matrix(table), _key_rank(table), k)
        lists = _lists(shape, table, qi, ci, d2, n)
        bound = np.full(n, np.inf)
        counts = np.bincount(qi, minlength=n)
        last = np.cumsum(counts) - 1
        full = counts >= k
        bound[full] = d2[last[full]]
        q, own, mine = _matrix(asked), asked.column("cell").to_numpy(), asked.column("reach").to_numpy()
        step = max(1, CHUNK_CELLS // len(spans))
        visits = []
        for s in range(0, max(1, n), step):
            part = slice(s, s + step)
            pairs = _visits(q[part], bound[part], own[part], mine[part], home)
            visits.append(_by_group(pairs, len(q[part]), in_group, n_blocks))
        return pa.table(
            [asked.column("key"), asked.column("vector"), lists, pa.array(bound), pa.concat_arrays(visits)],
            names=["key", "vector", "neighbors", "bound", "visit"],
        )

    def _visits(q: np.ndarray, bound: np.ndarray, own: np.ndarray, mine: np.ndarray, home: int) -> np.ndarray:
        """Pairs of query and block, in order."""
        if not len(q):
            return np.zeros((0, 2), dtype=np.int64)
        gaps, error = _to_pivots(q, pivots)
        reach, error = np.sqrt(bound)[:, None], error[:, None]
        far = reach + 1e-9 * (1.0 + gaps) + np.sqrt(error)
        with np.errstate(invalid="ignore", over="ignore"):  # what is no number rules nothing out
            # No point of a cell is nearer than the plane halfway between its pivot and the own one.
            beyond = gaps * gaps - (mine * mine)[:, None] > 2.0 * pivot_gaps[own] * far + 2.0 * error
            gap, far = gaps[:, span_cell], far[:, span_cell]
            miss = (gap - far > high) | (gap + far < low) | beyond[:, span_cell]
        hit = np.logical_or.reduceat(~miss, starts, axis=1)
        hit[:, home] = False
        return np.argwhere(hit)

    return answer


def _by_group(pairs: np.ndarray, n: int, in_group: int, n_blocks: int) -> pa.Array:
    """The blocks of every query, listed by group; an empty list means all of the group."""
    group = pairs[:, 1] // in_group
    new = np.ones(len(pairs), dtype=bool)
    new[1:] = (pairs[1:, 0] != pairs[:-1, 0]) | (group[1:] != group[:-1])
    starts = np.flatnonzero(new)
    counts = np.diff(np.append(starts, len(pairs)))
    size = np.minimum((group[starts] + 1) * in_group, n_blocks) - group[starts] * in_group
    listed = counts < size
    inner = np.append(0, np.cumsum(np.where(listed, counts, 0))).astype(np.int32)
    outer = np.searchsorted(pairs[starts, 0], np.arange(n + 1)).astype(np.int32)
    blocks = pa.ListArray.from_arrays(pa.array(inner), pa.array(pairs[np.repeat(listed, counts), 1].astype(np.int32)))
    items = pa.StructArray.from_arrays([pa.array(group[starts].astype(np.int32)), blocks], names=["group", "blocks"])
    return pa.ListArray.from_arrays(pa.array(outer), items)


def _visit(shape: _Shape, k: int):
    """Answer visitors from a group, block by block under a shrinking bound."""

    def answer(visitors: pa.Table, hosts: pa.Table) -> pa.Table:
        hosts = _plain(hosts)
        c, rank = _matrix(hosts), _key_rank(hosts)
        place, block = _sorted_by(hosts.column("block").to_numpy(), np.arange(len(hosts)))
        # At least one round, so that a group without visitors has a result of the right type.
        starts = range(0, max(1, len(visitors)), VISIT_ROWS)
        return pa.concat_tables([answered(_plain(visitors.slice(s, VISIT_ROWS)), hosts, c, rank, place, block) for s in starts])

    def answered(visitors: pa.Table, hosts: pa.Table, c: np.ndarray, rank: np.ndarray, place: np.ndarray, block: np.ndarray) -> pa.Table:
        n = len(visitors)
        q = _matrix(visitors)
        bound = visitors.column("bound").to_numpy().copy()
        lists = _whole(visitors.column("blocks"))
        lengths = lists.value_lengths().to_numpy()
        anywhere = np.flatnonzero(lengths == 0)  # these visit every block
        owner = np.repeat(np.arange(n), lengths)
        owner, wanted = _sorted_by(lists.flatten().to_numpy(), owner)
        best_d, best_c = np.full((n, k), np.inf), np.zeros((n, k), dtype=np.int64)
        for b in np.unique(block) if len(anywhere) else np.unique(wanted):
            who = owner[np.searchsorted(wanted, b) : np.searchsorted(wanted, b, side="right")]
            who = np.concatenate([anywhere, who])
            at = place[np.searchsorted(block, b) : np.searchsorted(block, b, side="right")]
            # Where all visit, they are not copied.
            qi, ci, d2 = _nearest(q if len(anywhere) == n else q[who], c[at], rank[at], k, bound[who])
            if not len(qi):
                continue
            some, qi = np.unique(qi, return_inverse=True)
            who = who[some]
            slot = np.arange(len(qi)) - np.searchsorted(qi, qi)
            new_d, new_c = np.full((len(who), k), np.inf), np.zeros((len(who), k), dtype=np.int64)
            new_d[qi, slot], new_c[qi, slot] = d2, at[ci]
            d, j = np.hstack([best_d[who], new_d]), np.hstack([best_c[who], new_c])
            order = np.lexsort((rank[j], d), axis=1)[:, :k]
            best_d[who], best_c[who] = np.take_along_axis(d, order, 1), np.take_along_axis(j, order, 1)
            bound[who] = np.minimum(bound[who], best_d[who, k - 1])
        held = np.isfinite(best_d)
        qi = np.repeat(np.arange(n), held.sum(axis=1))
        found = _lists(shape, hosts, qi, best_c[held], best_d[held], n)
        return pa.table([visitors.column("key"), found], names=["key", "neighbors"])

    return answer


def _sorted_by(values: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``other`` in the order of ``values``, and ``values`` sorted."""
    order = np.argsort(values, kind="stable")
    return other[order], values[order]

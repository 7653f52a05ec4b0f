"""Hard negatives by a multiway tree of split points with distance ranges between siblings.

A node of the tree has some split points; a vector goes to the child of its nearest one, which cuts
space by hyperplanes.  For every split point and every sibling the least and greatest distance from
that point to the vectors below the sibling are kept, taken over all rows.  A query looks for inner
products inside windows.  With one more coordinate that gives all vectors the same length, an inner
product is a distance to the query, so a window of products is an annulus, and the triangle
inequality turns the ranges into bounds on the distances of a whole subtree: a sibling whose bounds
meet no annulus of the query is eliminated.  Leaves that remain are compared exactly in integers.

The split points come from a bounded sample, the ranges and leaves from all rows.  Leaves are cut
into slices of bounded size and queries into chunks, so no task holds a whole leaf or all queries.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.llm.frames import checkpointed

#: Rows that split points are chosen from, split points of a node, and levels of nodes.
SAMPLE_ROWS, FAN, LEVELS = 4096, 8, 2
#: Rows of a leaf and queries that meet in one group, and products held at a time.
SLICE_ROWS, CHUNK_ROWS, PRODUCTS = 8192, 32768, 1 << 22
#: Distances are rounded; bounds give way by so much of the common length.
SLACK = 4e-6


@dataclass
class SplitTree:
    """Split points of each node, and its children: a node's number, or ``~leaf`` for a leaf.

    ``low[node][i, j]`` and ``high`` are the range of distances from point i to what lies below j.
    """

    norm2: float
    points: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    low: list[np.ndarray] = field(default_factory=list)
    high: list[np.ndarray] = field(default_factory=list)
    leaves: int = 0

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with the coordinate that gives all the same length."""
        rest = np.maximum(self.norm2 - (vectors * vectors).sum(axis=1), 0.0)
        return np.hstack([vectors, np.sqrt(rest)[:, None]])

    @staticmethod
    def distances(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
        square = (vectors * vectors).sum(axis=1)[:, None] + (points * points).sum(axis=1) - 2 * (vectors @ points.T)
        return np.sqrt(np.maximum(square, 0.0))

    def grow(self, sample: np.ndarray, fan: int, levels: int) -> int:
        """Adds the node over a sample of lifted vectors; what it returns is the child's number."""
        if levels == 0 or len(sample) < 2 * fan:
            self.leaves += 1
            return ~(self.leaves - 1)
        # Of a few candidates each next point is the one farthest from those chosen.
        some = sample[: 4 * fan]
        chosen, near = [0], self.distances(some, some[:1])[:, 0]
        while len(chosen) < fan and near.max() > SLACK * math.sqrt(self.norm2):
            chosen.append(int(near.argmax()))
            near = np.minimum(near, self.distances(some, some[chosen[-1:]])[:, 0])
        if len(chosen) < 2:
            self.leaves += 1
            return ~(self.leaves - 1)
        node = len(self.points)
        self.points.append(some[chosen])
        self.children.append([])
        owner = self.distances(sample, self.points[node]).argmin(axis=1)
        self.children[node] = [self.grow(sample[owner == j], fan, levels - 1) for j in range(len(chosen))]
        return node

    def routes(self, lifted: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """Every node with the rows that reach it, their distances to its points and their child."""
        waiting = [(0, np.arange(len(lifted)))] if self.points else []
        while waiting:
            node, at = waiting.pop()
            if not len(at):
                continue
            away = self.distances(lifted[at], self.points[node])
            owner = away.argmin(axis=1)
            yield node, at, away, owner
            waiting += [(c, at[owner == j]) for j, c in enumerate(self.children[node]) if c >= 0]

    def leaf_of(self, lifted: np.ndarray) -> np.ndarray:
        out = np.zeros(len(lifted), np.int32)
        for node, at, _, owner in self.routes(lifted):
            children = np.array(self.children[node])[owner]
            out[at[children < 0]] = ~children[children < 0]
        return out

    def visits(self, queries: np.ndarray, near: np.ndarray, far: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the queries that may find something there.

        ``near`` and ``far`` have a row for each query and a column for each annulus; a column
        with ``near > far`` is none.
        """
        slack = SLACK * math.sqrt(self.norm2)
        flat = np.hstack([queries, np.zeros((len(queries), 1))])
        # A query has its own length, so its distance to a lifted point follows from the product.
        everyone = np.arange(len(queries))
        if not self.points:
            yield 0, everyone[(near <= far).any(axis=1)]
            return
        waiting = [(0, everyone, np.zeros(len(queries)), np.full(len(queries), np.inf))]
        while waiting:
            node, at, least, most = waiting.pop()
            if not len(at):
                continue
            away = self.distances(flat[at], self.points[node])
            for j, child in enumerate(self.children[node]):
                low, high = self.low[node][:, j], self.high[node][:, j]
                if low[0] > high[0]:  # no row lies below
                    continue
                begin = np.maximum(least, np.maximum(away - high, low - away).max(axis=1)) - slack
                end = np.minimum(most, (away + high).min(axis=1)) + slack
                own_near, own_far = near[at], far[at]
                meets = ((own_near <= own_far) & (begin[:, None] <= own_far) & (end[:, None] >= own_near)).any(axis=1)
                if child >= 0:
                    waiting.append((child, at[meets], begin[meets], end[meets]))
                elif meets.any():
                    yield ~child, at[meets]


@dataclass(frozen=True)
class _Kind:
    """How vectors are packed into bytes, and the numbers their products are exact in."""

    packed: str
    exact: str
    width: int

    def read(self, column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        raw = b"".join(column.to_pylist())
        return np.frombuffer(raw, self.packed).reshape(len(column), self.width).astype(self.exact)


def _measured(own: DataFrame) -> tuple[_Kind, float]:
    """The packing that holds all components, and the greatest squared length."""
    size = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    greatest = F.array_max(F.transform("v", lambda x: F.abs(x.cast("double"))))
    most, norm2, width = own.agg(F.max(greatest), F.max(size), F.max(F.size("v"))).first()
    most, norm2, width = most or 0.0, norm2 or 0.0, width or 0
    if norm2 >= 2.0**62:
        raise ValueError("inner products do not fit a long")
    packed = "<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8"
    # Sums of products stay below the greatest squared length, so doubles are exact up to 2^53.
    return _Kind(packed, "f8" if norm2 < 2.0**52 else "i8", width), norm2


def _padded(values: pa.ListArray, width: int) -> np.ndarray:
    """A matrix of lists; shorter ones end in zeros."""
    counts = np.diff(values.offsets.to_numpy())
    out = np.zeros((len(values), width), np.int64)
    out[np.arange(width) < counts[:, None]] = values.flatten().to_numpy(zero_copy_only=False)
    return out


def _routing(tree: SplitTree, kind: _Kind):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 40
        for batch in batches:
            if not len(batch):
                continue
            vectors = _padded(batch.column("v"), kind.width)
            leaf = tree.leaf_of(tree.lifted(vectors.astype(np.float64)))
            packed = pa.array([row.tobytes() for row in vectors.astype(kind.packed)], pa.binary())
            spread = pa.array(place + np.arange(len(batch)))
            place += len(batch)
            columns = [*[batch.column(c) for c in ("id", "label", "anchor")], packed, pa.array(leaf), spread]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "anchor", "v", "leaf", "spread"])

    return run


def _ranging(tree: SplitTree, kind: _Kind):
    """Ranges of the rows of a task, one row for each node, point and sibling."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            lifted = tree.lifted(kind.read(batch.column("v")).astype(np.float64))
            for node, _, away, owner in tree.routes(lifted):
                for j in np.unique(owner).tolist():
                    own = away[owner == j]
                    low, high = own.min(axis=0), own.max(axis=0)
                    if (node, j) in found:
                        low, high = np.minimum(low, found[node, j][0]), np.maximum(high, found[node, j][1])
                    found[node, j] = low, high
        for (node, j), (low, high) in found.items():
            n = len(low)
            columns = [pa.array(np.full(n, node)), pa.array(np.arange(n)), pa.array(np.full(n, j)), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays(columns, ["node", "i", "j", "low", "high"])

    return run


def split_tree(own: DataFrame, kind: _Kind, norm2: float, sample_rows: int, fan: int, levels: int) -> SplitTree:
    """Split points from the ``sample_rows`` rows of least hash of the id; no ranges yet."""
    sample = own.select("v").orderBy(F.xxhash64("id"), "id").limit(sample_rows).toArrow()
    tree = SplitTree(norm2)
    if not len(sample):
        return tree
    vectors = _padded(sample.column("v").combine_chunks(), kind.width).astype(np.float64)
    _, first = np.unique(vectors, axis=0, return_index=True)
    if tree.grow(tree.lifted(vectors[np.sort(first)]), fan, levels) < 0:
        tree.points, tree.children = [], []
    return tree


def _with_ranges(tree: SplitTree, routed: DataFrame, kind: _Kind) -> None:
    tree.low = [np.full((len(p), len(p)), np.inf) for p in tree.points]
    tree.high = [np.full((len(p), len(p)), -np.inf) for p in tree.points]
    parts = routed.select("v").mapInArrow(_ranging(tree, kind), "node long, i long, j long, low double, high double")
    # One row for each pair of siblings: bounded by the tree.
    for node, i, j, low, high in parts.groupBy("node", "i", "j").agg(F.min("low"), F.max("high")).collect():
        tree.low[node][i, j], tree.high[node][i, j] = low, high


#: Bounds of a window that is open on a side.
_NONE_LEAST, _NONE_MOST = -(1 << 62), 1 << 62


def _walk(tree: SplitTree, kind: _Kind):
    """One row for each query and leaf that it has to visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            queries = kind.read(batch.column("v")).astype(np.float64)
            lists = [batch.column(c) for c in ("least", "most")]
            counts = np.diff(lists[0].offsets.to_numpy())
            square = (queries * queries).sum(axis=1)
            bounds = []
            for values, none in zip(lists, (1.0, -1.0)):
                score = np.full((len(batch), int(counts.max(initial=0))), none)
                inside = np.arange(score.shape[1]) < counts[:, None]
                score[inside] = values.flatten().to_numpy()
                bounds.append((score, inside))
            # The greater the product, the nearer.
            away = [
                np.where(inside, np.sqrt(np.maximum(square[:, None] + tree.norm2 - 2 * score, 0.0)), none)
                for (score, inside), none in zip(bounds, (-1.0, 1.0))
            ]
            impossible = bounds[0][0] > bounds[1][0]
            far, near = np.where(impossible, -1.0, away[0]), np.where(impossible, 1.0, away[1])
            for leaf, at in tree.visits(queries, near, far):
                if len(at):
                    part = batch.take(pa.array(at))
                    yield part.append_column("leaf", pa.array(np.full(len(at), leaf, np.int32)))

    return run


def _products(queries: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    step = max(1, PRODUCTS // max(1, len(rows)))
    for begin in range(0, len(queries), step):
        yield begin, (queries[begin : begin + step] @ rows.T).astype(np.int64)


def _scanner(kind: _Kind, same: bool, most: int):
    """The first ``most`` rows of a slice for each query and window, of the same or of other labels."""

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.array([], pa.int64())
        if not len(rows) or not len(queries):
            return pa.Table.from_arrays([empty] * len(_FOUND), _FOUND)
        row_id, row_label = (rows.column(c).to_numpy() for c in ("id", "label"))
        query_id, query_label, own = (queries.column(c).to_numpy() for c in ("query", "query_label", "own"))
        lows, highs = (queries.column(c).combine_chunks() for c in ("least", "most"))
        begins = lows.offsets.to_numpy()
        low, high = lows.values.to_numpy(), highs.values.to_numpy()
        windows = np.diff(begins)
        out = []
        for begin, score in _products(kind.read(queries.column("query_v")), kind.read(rows.column("v"))):
            at = np.arange(begin, begin + len(score))
            allowed = query_label[at][:, None] == row_label
            allowed = allowed & (query_id[at][:, None] != row_id) if same else ~allowed
            for w in range(int(windows[at].max(initial=0))):
                has = np.flatnonzero(windows[at] > w)
                place = begins[at[has]] + w
                part = score[has]
                q, r = np.nonzero(allowed[has] & (part >= low[place][:, None]) & (part <= high[place][:, None]))
                value = part[q, r]
                order = np.lexsort((row_id[r], -value, q))
                q, r, value = q[order], r[order], value[order]
                rank = np.arange(len(q)) - np.searchsorted(q, q)
                q, r, value = (x[rank < most] for x in (q, r, value))
                whose = at[has[q]]
                out.append((query_id[whose], own[whose], np.full(len(q), w), row_id[r], value))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], _FOUND)

    return run


_FOUND = ["query", "own", "w", "found", "score"]


class HardNegatives:
    """The tree over all rows of a table, and the searches of its queries."""

    def __init__(self, rows: DataFrame, sample_rows: int, fan: int, levels: int):
        self.kind, norm2 = _measured(rows)
        self.tree = split_tree(rows, self.kind, norm2, sample_rows, fan, levels)
        self.routed = checkpointed(
            rows.mapInArrow(
                _routing(self.tree, self.kind), "id long, label long, anchor boolean, v binary, leaf int, spread long"
            )
        )
        _with_ranges(self.tree, self.routed, self.kind)
        # One row a leaf.
        sizes = {r["leaf"]: r["count"] for r in self.routed.groupBy("leaf").count().collect()}
        self.slices = {leaf: max(1, math.ceil(n / SLICE_ROWS)) for leaf, n in sizes.items()}
        queries = self.routed.where("anchor").select("id", F.xxhash64("label", "v").alias("own"), "label", "v", "leaf")
        queries = checkpointed(queries.dropDuplicates(["id", "own"]))
        self.chunks = max(1, math.ceil(queries.count() / CHUNK_ROWS))
        chunk = F.pmod(F.xxhash64("id", "own"), F.lit(self.chunks)).cast("int")
        self.queries = queries.withColumn("chunk", chunk)

    def _slices_of(self, leaf: Column) -> Column:
        pairs = [F.lit(x) for pair in self.slices.items() for x in pair]
        return F.coalesce(F.create_map(*pairs)[leaf], F.lit(1)) if pairs else F.lit(1)

    def scan(self, visits: DataFrame, same: bool, most: int) -> DataFrame:
        """``query, own, w, found, score``: of each slice the first rows of each visit and window."""
        n = self._slices_of(F.col("leaf"))
        rows = self.routed.select("id", "label", "v", "leaf", F.pmod(F.xxhash64("spread"), n).cast("int").alias("slice"))
        rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(self.chunks - 1))))
        visits = visits.withColumn("slice", F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))))
        # Both sides come from one table, so the other side's columns get names of their own.
        visits = visits.select(
            *[F.col(c).alias(n) for c, n in (("id", "query"), ("label", "query_label"), ("v", "query_v"))],
            *[F.col(c).alias(c) for c in ("own", "least", "most", "leaf", "slice", "chunk")],
        )
        group = ("leaf", "slice", "chunk")
        met = rows.groupBy(*group).cogroup(visits.groupBy(*group))
        return met.applyInArrow(_scanner(self.kind, same, most), "query long, own long, w long, found long, score long")

    def visits(self, queries: DataFrame) -> DataFrame:
        """Queries with ``wanted``, ``least`` and ``most``, once for each leaf they have to visit."""
        return queries.select("chunk", "id", "own", "label", "v", "least", "most").mapInArrow(
            _walk(self.tree, self.kind),
            "chunk int, id long, own long, label long, v binary, least array<long>, most array<long>, leaf int",
        )


def _first(found: DataFrame, most: int, *group: str) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc("score"), "found")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _percent(score: Column, percent: int, rounded: Callable[[Column], Column]) -> Column:
    """``percent`` of a long, rounded to a whole number without leaving longs."""
    rest = F.pmod(score, F.lit(100).cast("long"))
    hundreds = F.call_function("div", score - rest, F.lit(100).cast("long"))
    return hundreds * percent + rounded(rest * percent / 100)


def mine_hard_negatives(
    rows: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "vector",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    sample_rows: int = SAMPLE_ROWS,
    fan: int = FAN,
    levels: int = LEVELS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vector`` is an array of whole numbers, ``key`` a whole number.  An anchor's positives are the
    first ``positives`` other rows of its label by inner product, ties by the lesser key; its
    negatives for a positive are the first rows of other labels whose score lies from ``low`` to
    ``high`` percent of the positive's.  The result is exact.

    Rows with a null key, label, vector or component take no part.  A shorter vector ends in
    zeros.  Rows of the anchor's own key are never its positives; repeated rows count each as
    other rows' partners, and as an anchor once.  An anchor without positives, and a positive
    without negatives in its window, have no rows.  Other columns are not looked at.  Squared
    lengths of 2^62 and more are an error, since scores would not fit a long.
    """
    own = rows.select(
        F.col(key).cast("long").alias("id"),
        F.when(F.col(label).isNotNull(), F.xxhash64(label)).alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform(vector, lambda x: x.cast("long")).alias("v"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
    own = own.where(~F.exists("v", lambda x: x.isNull()))
    table = HardNegatives(own, sample_rows, fan, levels)

    # An anchor's own leaf gives a lower bound of the last positive's score.
    open_window = [F.array(F.lit(v).cast("long")).alias(n) for n, v in (("least", _NONE_LEAST), ("most", _NONE_MOST))]
    seeds = table.scan(table.queries.select("*", *open_window), True, positives)
    seeds = seeds.groupBy("query", "own").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s"))
    seeds = seeds.select(F.col("query").alias("id"), "own", F.get("s", F.lit(positives - 1)).alias("bound"))
    bounded = table.queries.drop("leaf").join(seeds, ["id", "own"], "left")
    bounded = bounded.withColumns(
        {"least": F.array(F.coalesce("bound", F.lit(_NONE_LEAST))), "most": F.array(F.lit(_NONE_MOST).cast("long"))}
    )
    found = _first(table.scan(table.visits(bounded), True, positives), positives, "query", "own")
    found = checkpointed(found.select("query", "own", "found", "score", (F.col("rank") - 1).cast("long").alias("w")))

    # Whole-number bounds of each positive's window, in the order of the positives.
    ranked = found.groupBy("query", "own").agg(F.array_sort(F.collect_list(F.struct("w", "score"))).alias("p"))
    ranked = ranked.select(
        F.col("query").alias("id"),
        "own",
        F.transform("p", lambda x: _percent(x["score"], low, F.ceil)).alias("least"),
        F.transform("p", lambda x: _percent(x["score"], high, F.floor)).alias("most"),
    )
    asked = table.queries.drop("leaf").join(ranked, ["id", "own"])
    wrong = table.scan(table.visits(asked), False, negatives)
    chosen = _first(wrong, negatives, "query", "own", "w").withColumnRenamed("score", "negative_score")
    partner = found.select("query", "own", "w", F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    return chosen.join(partner, ["query", "own", "w"]).select(
        F.col("query").alias("anchor_id"),
        "positive_id",
        "rank",
        F.col("found").alias("negative_id"),
        "positive_score",
        "negative_score",
    )

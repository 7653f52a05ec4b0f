"""The trie of conversation prefixes, read off sorted paths by range minima.

A turn is 16 bytes of a digest of its role and text, and a path is the turns of a conversation one
after the other.  Equal paths are one row with their count, so a group of copies is no hot spot.
Paths are sorted over range partitions.  With the common prefix length (LCP) of each path and the
one before it, the conversations below a prefix of ``d`` turns are the stretch around one of them
in which no LCP falls below ``d``.  A sparse table holds the least LCP of every stretch of a power of
two, so each prefix finds the left and the right end of its stretch by binary search, independently
of all others and without a stack; members, leaves and saved tokens are differences of running sums,
and the least member is another range minimum.

A stretch that meets a border of its partition may go on beyond it.  Its parts, at most two for
each depth of a border, are added up by a shuffle afterwards; all other prefixes are done in place.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tierwise.llm.frames import checkpointed, partitions

#: Bytes of a turn in a path.
TURN = 16
#: Bytes of paths in a partition, about.
PART_BYTES = 16 << 20
#: Conversations whose ids are joined to one string before equal paths are brought together.
IDS_TOGETHER = 1024
#: Border prefixes that are broadcast; two for each partition and depth.
FEW_PREFIXES = 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()


class RangeMin:
    """A sparse table: the least value of any stretch, from two overlapping powers of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [np.asarray(values)]
        size = 1
        while 2 * size <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-size], last[size:]))
            size *= 2

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The least of ``values[first..last]``, both ends included."""
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), self.rows[0].dtype)
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.rows[k][first[at]], self.rows[k][last[at] - (1 << k) + 1])
        return out

    def reach_right(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The last place to which all values after ``start`` are at least ``bound``."""
        at, n = start.copy(), len(self.rows[0])
        for k in range(len(self.rows) - 1, -1, -1):
            can = np.flatnonzero(at + (1 << k) < n)
            go = can[self.rows[k][at[can] + 1] >= bound[can]]
            at[go] += 1 << k
        return at

    def reach_left(self, start: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first place from which all values up to ``start``, save its own, are at least ``bound``."""
        at = start.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            can = np.flatnonzero(at >= 1 << k)
            go = can[self.rows[k][at[can] - (1 << k) + 1] >= bound[can]]
            at[go] -= 1 << k
        return at


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with together."""
    n = min(len(a), len(b)) // TURN
    x, y = (np.frombuffer(p, np.uint8, n * TURN).reshape(n, TURN) for p in (a, b))
    differ = np.flatnonzero((x != y).any(axis=1))
    return int(differ[0]) if len(differ) else n


def _common_with_previous(paths: list[bytes]) -> np.ndarray:
    """The common turns of each path with the one before; 0 for the first."""
    out = np.zeros(len(paths), np.int64)
    for i in range(1, len(paths)):
        out[i] = _common(paths[i - 1], paths[i])
    return out


def _merged(batches: Iterator[pa.RecordBatch]):
    """Paths of a partition with their turns' lengths, members, least member and ends.

    Rows come by path and then by number, so ids of one path are hashed as they pass.
    """
    paths: list[bytes] = []
    lengths: list[np.ndarray] = []
    members: list[int] = []
    least: list[int] = []
    ends: list[str] = []
    running = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("path", "ids", "n", "least")]
        sizes = batch.column("lengths")
        for i, (path, ids, n, low) in enumerate(zip(*columns)):
            if paths and path == paths[-1]:
                running.update(b"," + ids.encode())
                members[-1] += n
                least[-1] = min(least[-1], low)
                continue
            if running is not None:
                ends.append(running.hexdigest())
            running = hashlib.sha256(ids.encode())
            paths.append(path)
            lengths.append(sizes[i].values.to_numpy())
            members.append(n)
            least.append(low)
    if running is not None:
        ends.append(running.hexdigest())
    return paths, lengths, np.array(members, np.int64), np.array(least, np.int64), ends


_SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_NODE = (
    "prefix binary, parent binary, whole boolean, depth long, conv_id long, parent_conv_id long, "
    + ", ".join(f"{c} long" for c in _SUMS)
    + ", ends_sha256 string"
)


def partition_nodes(paths, lengths, members, least, ends, before: int, after: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_NODE`` for the prefixes of sorted different paths.

    ``before`` and ``after`` are the common turns with the path before the first and after the
    last one; -1 where there is none.  A prefix that reaches over a border is not ``whole``.
    """
    n = len(paths)
    common = _common_with_previous(paths)
    common[0] = before
    depth = np.array([len(p) // TURN for p in paths], np.int64)
    starts = np.zeros(n + 1, np.int64)
    np.cumsum(depth + 1, out=starts[1:])
    # Characters of each path's first turns, from none to all.
    chars = np.zeros(starts[-1], np.int64)
    for i, own in enumerate(lengths):
        np.cumsum(own, out=chars[starts[i] + 1 : starts[i + 1]])
    total = chars[starts[1:] - 1]
    following = np.append(common[1:], after)
    leaf = following < depth
    # Prefixes that begin at a path; those of the border that only go on here have no head.
    new = np.maximum(depth - common, 0)
    own = np.maximum(common, 0)
    sums = [np.concatenate([[0], np.cumsum(x)]) for x in (members, leaf, members * total, total - chars[starts[:-1] + own])]

    goes_on = np.arange(0, before + 1)
    who = np.concatenate([np.zeros(len(goes_on), np.int64), np.repeat(np.arange(n), new)])
    at = np.arange(len(who) - len(goes_on)) - np.repeat(np.cumsum(new) - new, new)
    at = np.concatenate([goes_on, common[who[len(goes_on) :]] + 1 + at])
    head = np.arange(len(who)) >= len(goes_on)

    heights, low = RangeMin(common), RangeMin(least)
    left, right = heights.reach_left(who, at), heights.reach_right(who, at)
    whole = head & ~((right == n - 1) & (after >= at))

    # Children begin in the stretch where the path is longer and the common part ends at the depth.
    heads = np.sort(at[head] * n + who[head])
    children = np.searchsorted(heads, (at + 1) * n + right, "right") - np.searchsorted(heads, (at + 1) * n + left, "left")

    span = [s[right + 1] - s[left] for s in sums]
    above = np.where(at > 0, chars[starts[who] + np.maximum(at - 1, 0)], 0)
    # Of its first path a prefix counts the turns from its own depth on, not only those that begin there.
    first = np.where(head, chars[starts[left] + own[left]] - above, 0)
    saved = span[2] - span[0] * above - (span[3] + first)
    parent_left, parent_right = (f(who, at - 1) for f in (heights.reach_left, heights.reach_right))
    parent_here = (at > 0) & ~((parent_left == 0) & (before >= at - 1)) & ~((parent_right == n - 1) & (after >= at - 1))
    member, parent_member = low.least(left, right), low.least(parent_left, parent_right)
    closes = head & (depth[left] == at)

    step = 1 << 14
    for begin in range(0, len(who), step):
        rows = slice(begin, begin + step)
        place, upto, done, known = who[rows].tolist(), at[rows].tolist(), whole[rows], parent_here[rows]
        # Only prefixes that are looked up again are named.
        name = lambda i, d: hashlib.sha256(paths[i][: d * TURN]).digest()[:TURN] + d.to_bytes(8, "big")
        prefix = [None if w else name(i, d) for i, d, w in zip(place, upto, done.tolist())]
        parent = [None if k or d == 0 else name(i, d - 1) for i, d, k in zip(place, upto, known.tolist())]
        finish = [ends[i] if c else NO_ENDS for i, c in zip(left[rows].tolist(), closes[rows].tolist())]
        columns = [
            pa.array(prefix, pa.binary()),
            pa.array(parent, pa.binary()),
            pa.array(done),
            pa.array(at[rows]),
            pa.array(member[rows]),
            pa.array(parent_member[rows], mask=~known),
            *[pa.array(x[rows].astype(np.int64)) for x in (span[0], children, span[1], saved)],
            pa.array(finish),
        ]
        yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _NODE.split(", ")])


def sorted_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turns``: digest and length of the turns of each conversation, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * TURN)
    turn = F.struct("turn", digest.alias("digest"), F.length(text).cast("long").alias("length"))
    own = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    ordered = own.groupBy("conv_id").agg(F.array_sort(F.collect_list("t"), _by_turn).alias("turns"))
    return ordered.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"], t["length"])).alias("turns"))


def _by_turn(a: Column, b: Column) -> Column:
    """Null turns first, then by turn and digest."""
    order = F.lit(0)
    for c in ("digest", "turn"):
        x, y = a[c], b[c]
        order = F.when(x.isNull() & y.isNotNull(), -1).when(x.isNotNull() & y.isNull(), 1).when(x < y, -1).when(x > y, 1).otherwise(order)
    return order


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each prefix of ``conversations(conv_id, turns)``, with ``turns`` as of ``sorted_turns``.

    ``conv_id`` least member, ``depth``, ``parent_conv_id`` least member of the parent (null for
    the root), ``n_convs`` members, ``n_children``, ``n_leaves`` childless prefixes below or at it,
    ``saved_tokens`` characters not read again if each prefix below or at it is read once, and
    ``ends_sha256`` of the ids, ascending and joined by commas, that end here.

    Every ``conv_id`` must be one row and not null.  A conversation without turns ends at the root.
    Without conversations there is no root.  The digests of one conversation are one row; texts
    are not kept.
    """
    spark = conversations.sparkSession
    paths = conversations.select(
        "conv_id",
        F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), "")).alias("path"),
        F.transform("turns", lambda t: t["length"]).alias("lengths"),
    )
    together = F.floor(F.col("conv_id") / IDS_TOGETHER).alias("part")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = checkpointed(
        paths.groupBy("path", together).agg(
            ids.alias("ids"),
            F.count(F.lit(1)).alias("n"),
            F.min("conv_id").alias("least"),
            F.first("lengths").alias("lengths"),
        )
    )
    nbytes = chunks.agg(F.sum(F.length("path") + F.length("ids") + 64)).first()[0] or 0
    count = max(partitions(spark), math.ceil(nbytes / PART_BYTES))
    dealt = chunks.repartitionByRange(count, "path").sortWithinPartitions("path", "part")
    dealt = checkpointed(dealt.withColumn("home", F.spark_partition_id()))

    # One row for each partition.
    borders = dealt.groupBy("home").agg(F.min("path").alias("first"), F.max("path").alias("last")).orderBy("home").collect()
    between = [_common(bytes(a["last"]), bytes(b["first"])) for a, b in zip(borders, borders[1:])]
    common = {row["home"]: (b, a) for row, b, a in zip(borders, [-1, *between], [*between, -1])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        home: list[int] = []

        def noted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if len(batch):
                    home[:] = [batch.column("home")[0].as_py()]
                    yield batch

        own = _merged(noted())
        if own[0]:
            yield from partition_nodes(*own, *common[home[0]])

    nodes = checkpointed(dealt.mapInArrow(run, _NODE))
    parts = nodes.where("not whole")
    joined = checkpointed(
        parts.groupBy("prefix").agg(
            F.first("parent").alias("parent"),
            F.first("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in _SUMS],
            # Only the part that holds the prefix's first path knows what ends there.
            F.coalesce(F.min(F.when(F.col("ends_sha256") != NO_ENDS, F.col("ends_sha256"))), F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
    few = joined.count() <= FEW_PREFIXES
    above = joined.select(F.col("prefix").alias("parent"), F.col("conv_id").alias("_above"))
    above = F.broadcast(above) if few else above
    columns = ["conv_id", "depth", F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"), *_SUMS, "ends_sha256"]
    done = nodes.where("whole").select("parent", "parent_conv_id", "conv_id", "depth", *_SUMS, "ends_sha256")
    cut = joined.select("parent", F.lit(None).cast("long").alias("parent_conv_id"), "conv_id", "depth", *_SUMS, "ends_sha256")
    return done.unionByName(cut).join(above, "parent", "left").select(*columns)


def with_shared_openings(turns: DataFrame) -> DataFrame:
    """Conversations that begin with turns of another one, in the form that ``prefix_trie`` takes.

    Conversation c gets the first ``crc32(c as text) % 6`` turns of conversation ``c - c % 100`` in
    place of its own; all that there are, if fewer.
    """
    own = sorted_turns(turns)
    base, held = F.col("conv_id") - F.col("conv_id") % 100, (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    openings = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("_base"), F.slice("turns", 1, 5).alias("_opening"))
    both = own.withColumns({"_base": base, "_held": held}).join(openings, "_base", "left")
    opening = F.coalesce(F.slice("_opening", F.lit(1), F.col("_held")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("_held") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return both.select("conv_id", F.concat(opening, rest).alias("turns"))

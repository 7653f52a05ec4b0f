"""Document fingerprints by a randomised edit embedding.

A pointer walks over the characters of a text.  At step ``j`` it looks at its character and
moves on if the shared random bit for (step, kind of character) is 1, else it stays.  Texts that
differ by few edits fall into step again soon after each, so the edit distance becomes a Hamming
distance between what the pointers see at equal steps.  The fingerprint keeps a random bit of
what is seen at sampled steps: 256 in each octave [2^k, 2^(k+1)) of the steps, for the four
longest octaves of the walk, which hold 15 of 16 steps.  Bands of those bits propose pairs,
whole fingerprints verify them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierwise.llm.blocks import meet_in_blocks
from tierwise.llm.frames import partitions
from tierwise.llm.words import mix, slices

KINDS = 128
#: The shared bits repeat after so many steps.
PERIOD = 1 << 13
BITS, OCTAVES = 256, 4
BAND_BITS = 16
#: So many of the longest texts of a batch end their walk alone.
FEW = 16
#: Texts walked over together, in bytes.
WALK_BYTES = 8 << 20


def _shared_steps() -> np.ndarray:
    """For (kind, step): how many steps a pointer spends on a character of the kind met at the step."""
    at = np.arange(KINDS * PERIOD, dtype=np.uint64)
    bits = ((mix(at, 0x7F4A7C15) >> np.uint64(40)) & np.uint64(1)).astype(bool).reshape(KINDS, PERIOD)
    bits[:, -1] = True
    step = np.arange(PERIOD)
    stop = np.where(bits, step, PERIOD)
    stop = np.minimum.accumulate(stop[:, ::-1], axis=1)[:, ::-1]
    return (stop - step + 1).astype(np.int32).reshape(-1)


_DWELL = _shared_steps()


@cache
def _dwell_list() -> list[int]:
    return _DWELL.tolist()


@cache
def _samples(octave: int) -> np.ndarray:
    """Sampled steps of an octave, ascending; all of them where there are no more than BITS."""
    low, size = (1 << octave, 1 << octave) if octave else (0, 2)
    if size <= BITS:
        return np.arange(low, low + size)
    cell = size // BITS
    jitter = mix(np.arange(BITS, dtype=np.uint64), 0xB5297A4D + octave) % np.uint64(cell)
    return low + np.arange(BITS) * cell + jitter.astype(np.int64)


def _seen_bit(steps: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    return (mix(steps.astype(np.uint64) * np.uint64(KINDS) + kinds.astype(np.uint64), 0x68E31DA4) >> np.uint64(63)).astype(bool)


def _walk_alone(kinds: list[int], step: int) -> list[int]:
    table, last, out = _dwell_list(), PERIOD - 1, []
    for kind in kinds:
        step += table[kind * PERIOD + (step & last)]
        out.append(step)
    return out


def _walk(kinds: np.ndarray, starts: np.ndarray, sizes: np.ndarray, begun: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The step at which each character is left, and the last one; walks go on from steps ``begun``.

    All texts move together, a character at a time, until the few longest are left.
    """
    left = np.zeros(len(kinds), np.int32)
    order = np.argsort(-sizes, kind="stable")
    begin, size = starts[order], sizes[order]
    step = begun[order].astype(np.int32)
    together = int(size[FEW]) if len(size) > FEW else 0
    alive = len(order)
    for i in range(together):
        while size[alive - 1] <= i:
            alive -= 1
        at = begin[:alive] + i
        now = step[:alive]
        now += _DWELL[kinds[at] * PERIOD + (now & (PERIOD - 1))]
        left[at] = now
    for n in range(min(FEW, len(order))):
        if size[n] > together:
            rest = slice(begin[n] + together, begin[n] + size[n])
            left[rest] = _walk_alone(kinds[rest].tolist(), int(step[n]))
            step[n] = left[rest.stop - 1]
    taken = np.empty(len(order), np.int64)
    taken[order] = step
    return left, taken


def _kinds(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The kind of each character of all texts, and where each text starts and how long it is."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return ((points ^ (points >> np.uint32(7))) & np.uint32(KINDS - 1)).astype(np.int32), np.cumsum(sizes) - sizes, sizes


def _written(kinds: np.ndarray, left: np.ndarray, starts: np.ndarray, sizes: np.ndarray, taken: np.ndarray) -> list[str]:
    out = []
    for start, size, steps in zip(starts.tolist(), sizes.tolist(), taken.tolist()):
        if not size:
            out.append("0:")
            continue
        top = (steps - 1).bit_length() - 1 if steps > 1 else 0
        where = np.concatenate([_samples(k) for k in range(max(0, top - OCTAVES + 1), top + 1)])
        at = np.searchsorted(left[start : start + size], where, "right")
        inside = at < size
        bits = np.zeros(len(where), bool)
        bits[inside] = _seen_bit(where[inside], kinds[start + at[inside]])
        out.append(f"{steps:x}:{np.packbits(bits).tobytes().hex()}")
    return out


def fingerprint_texts(texts: list[str]) -> list[str]:
    """``steps:bits`` for each text: steps of the walk in hex, then the sampled bits in hex.

    Equal texts have equal fingerprints; the empty text gives ``0:``.
    """
    kinds, starts, sizes = _kinds(texts)
    return _written(kinds, *_walked(kinds, starts, sizes))


def _walked(kinds: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    left, taken = _walk(kinds, starts, sizes, np.zeros(len(sizes), np.int32))
    return left, starts, sizes, taken


def fingerprint_changed(texts: list[str], changed: list[str], kept: list[int]) -> tuple[list[str], list[str]]:
    """Fingerprints of ``texts`` and of ``changed``, whose first ``kept`` characters are those of the text.

    Equal beginnings are walked equally, so only what follows them is walked again.
    """
    kinds, starts, sizes = _kinds(texts)
    own = _walked(kinds, starts, sizes)
    new_kinds, new_starts, new_sizes = _kinds(changed)
    keep = np.asarray(kept, np.int64)
    begun = np.where(keep > 0, own[0][np.maximum(starts[: len(keep)] + keep - 1, 0)], 0) if len(own[0]) else keep
    left, taken = _walk(new_kinds, new_starts + keep, new_sizes - keep, begun)
    for i, j, n in zip(starts.tolist(), new_starts.tolist(), kept):
        left[j : j + n] = own[0][i : i + n]
    return _written(kinds, *own), _written(new_kinds, left, new_starts, new_sizes, taken)


def _unpack(fingerprint: str) -> tuple[int, dict[int, np.ndarray]]:
    steps, bits = fingerprint.split(":")
    taken = int(steps, 16)
    if not taken:
        return 0, {}
    top = (taken - 1).bit_length() - 1 if taken > 1 else 0
    flat = np.unpackbits(np.frombuffer(bytes.fromhex(bits), np.uint8))
    out, at = {}, 0
    for k in range(max(0, top - OCTAVES + 1), top + 1):
        n = len(_samples(k))
        out[k] = flat[at : at + n]
        at += n
    return taken, out


def likeness(one: str, other: str) -> float:
    """The share of steps at which both walks see the same, between 0 and 1.

    Sampled bits agree by chance half of the time, which is taken off.  Steps that only the
    longer walk has count as different.  Two empty texts are alike, an empty and another are not.
    """
    if one == other:
        return 1.0
    (n, a), (m, b) = _unpack(one), _unpack(other)
    if not n or not m:
        return 0.0
    short, long, alike, total = min(n, m), max(n, m), 0.0, 0.0
    for k in set(a) | set(b):
        where = _samples(k)
        counted, both = np.searchsorted(where, (long, short)).tolist()
        steps = min(long, 2 << k) - (1 << k if k else 0)
        total += steps
        if both and k in a and k in b:
            same = 2.0 * int((a[k][:both] == b[k][:both]).sum()) - both
            alike += steps * same / counted
    return min(1.0, max(0.0, alike / total)) if total else 0.0


def band_keys(fingerprint: str, short: float = BAND_BITS) -> list[str]:
    """Octave, place and value of each band of BAND_BITS sampled bits.

    A walk of fewer than ``short`` steps also has the band that all such walks share.
    """
    steps, octaves = _unpack(fingerprint)
    keys = ["short"] if 0 < steps < short else []
    for k, bits in octaves.items():
        for i in range(0, len(bits) - BAND_BITS + 1, BAND_BITS):
            keys.append(f"{k}.{i}.{np.packbits(bits[i : i + BAND_BITS]).tobytes().hex()}")
    return keys


def _batches(fn, columns: list[str], keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch, columns[0], WALK_BYTES):
                part = batch.slice(low, high - low)
                made = fn(*[[x or "" for x in part.column(c).to_pylist()] for c in columns])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], pa.array(made)], [*keep, "fingerprint"])

    return run


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint`` for each row; a null text counts as empty.  No shuffle."""
    own = docs.select(F.col(key), F.col(text))
    schema = T.StructType([own.schema[key], T.StructField("fingerprint", T.StringType())])
    return own.mapInArrow(_batches(fingerprint_texts, [text], [key]), schema)


def _band_column(short: float):
    return F.pandas_udf(lambda a: a.map(lambda x: band_keys(x, short)), T.ArrayType(T.StringType()))


def _alike_in_block(least: float):
    def meet(table: pa.Table, meetings: Iterator[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        ids, prints = table.column("node"), table.column("fingerprint").to_pylist()
        parts = [_unpack(p) for p in prints]
        taken = np.array([steps for steps, _ in parts])
        has, seen = {}, {}
        for k in sorted({k for _, bits in parts for k in bits}):
            has[k] = np.array([k in bits for _, bits in parts])
            seen[k] = np.zeros((len(parts), len(_samples(k))), np.uint8)
            for row in np.flatnonzero(has[k]):
                seen[k][row] = parts[row][1][k]
        one, two, found = [], [], []
        for i, others in meetings:
            short, long = np.minimum(taken[others], taken[i]), np.maximum(taken[others], taken[i])
            alike, total = np.zeros(len(others)), np.zeros(len(others))
            for k, where in ((k, _samples(k)) for k in has):
                steps = np.minimum(long, 2 << k) - (1 << k if k else 0)
                total += np.where(has[k][others] | has[k][i], steps, 0)
                counted, both = np.searchsorted(where, long), np.searchsorted(where, short)
                equal = (seen[k][others] == seen[k][i]) & (np.arange(len(where)) < both[:, None])
                share = (2.0 * equal.sum(axis=1) - both) / np.maximum(counted, 1)
                alike += np.where(has[k][others] & has[k][i] & (both > 0), steps * share, 0)
            for k in others[alike >= (least - 1e-9) * total].tolist():
                value = likeness(prints[i], prints[k])
                if value >= least:
                    one.append(i)
                    two.append(k)
                    found.append(value)
        columns = [ids.take(pa.array(x, pa.int64())).combine_chunks() for x in (one, two)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64())], ["a", "b", "likeness"])

    return meet


def equal_fingerprints(prints: DataFrame, key: str = "doc_id") -> DataFrame:
    """``key, id`` for each row: the least key with the row's fingerprint, which stands for it in ``alike_pairs``."""
    least = prints.groupBy("fingerprint").agg(F.min(key).alias("id"))
    return prints.join(least, "fingerprint").select(key, "id")


def alike_pairs(prints: DataFrame, key: str = "doc_id", least: float = 0.8) -> DataFrame:
    """``a, b, likeness`` of all pairs of different fingerprints that share a band and are alike enough.

    Rows with one fingerprint are copies: the least key stands for them, so copies make no pairs;
    ``equal_fingerprints`` has them.  All members of a band bucket meet, in blocks of bounded
    size.  Walks too short for bands are met by all walks that can be alike (for ``least`` of a
    half or more).  Empty texts have no bands and no partners; rows with a null key are left out.
    """
    prints = prints.where(F.col(key).isNotNull()).groupBy("fingerprint").agg(F.min(key).alias("node"))
    # Likeness is at most the shorter walk's share of the longer one.
    bands = prints.withColumn("bucket", F.explode(_band_column(BAND_BITS / max(least, 0.5) + 1)("fingerprint")))
    kind = prints.schema["node"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("likeness", T.DoubleType())])
    pairs = meet_in_blocks(bands.withColumn("bucket", F.xxhash64("bucket")), schema, _alike_in_block(least))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness").distinct()


def _edited(own: list[str], after: list[str]) -> list[str]:
    out = []
    for text, new in zip(own, after):
        n = len(text) // 4
        out.append(text[: len(text) - n] + new[:n])
    return out


def _pair_rows(key: str):
    """Rows of a range in order, each with the next; a range ends with a copy of the next one's first."""

    def made(ids: pa.Array, texts: list[str], after: list[str]) -> pa.RecordBatch:
        n, changed = len(texts), _edited(texts, after)
        # The next row's fingerprint is that of the following text; only the last one's is extra.
        prints, others = fingerprint_changed([*texts, after[-1]], changed, [len(t) - len(t) // 4 for t in texts])
        own, nexts = prints[:n], prints[1:]
        return pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(changed, pa.string()),
                pa.array(own, pa.string()),
                pa.array(others, pa.string()),
                pa.array([likeness(a, b) for a, b in zip(own, others)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(own, nexts)], pa.float64()),
            ],
            [key, "n_chars", "edited_text", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # the last row so far, whose next is still to come
        for batch in batches:
            for low, high in slices(batch, "_text", WALK_BYTES // 2):
                part = batch.slice(low, high - low)
                texts = [t or "" for t in part.column("_text").to_pylist()]
                rows = [*waiting, *zip(part.column("_key").to_pylist(), texts, part.column("_tail").to_pylist())]
                waiting = [] if rows[-1][2] else rows[-1:]
                pairs = [(a[0], a[1], b[1]) for a, b in zip(rows, rows[1:]) if not a[2]]
                if not pairs:
                    continue
                own, first, after = zip(*pairs)
                # Two ranges may meet in one batch: a new stretch begins where a text is not the one before's next.
                cuts = [0, *[i for i in range(1, len(pairs)) if first[i] is not after[i - 1]], len(pairs)]
                for i, j in zip(cuts, cuts[1:]):
                    yield made(pa.array(own[i:j], part.column("_key").type), list(first[i:j]), list(after[i:j]))

    return run


def _range_number(key: Column, bounds: list, kind: T.DataType) -> Column:
    """How many bounds are at or below ``key``, found over a coarse and then a fine list; 0 for null."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds) - 1) + 1
    fine = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    literal = lambda values: F.array(*[F.lit(v).cast(kind) for v in values])
    below = lambda values: F.size(F.filter(values, lambda b: b <= key))
    block = F.greatest(below(literal([f[0] for f in fine])) - 1, F.lit(0))
    return F.when(key.isNull(), 0).otherwise(block * width + below(F.get(F.array(*map(literal, fine)), block)))


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of a changed copy, and how alike they are.

    The changed copy has the last floor(n/4) code points replaced by as many first ones, or all,
    of the next document in ascending ``key``; the first follows the last.  Rows without a key
    come first, rows with one key follow each other by text.  A null text is empty.  The only row
    is its own next.  Returns ``key, n_chars, edited_text, fingerprint, edited_fingerprint,
    near_edited, near_next``.

    Rows are dealt into ranges of the key, as many as shuffle partitions, in one shuffle of the
    texts, and streamed in order; the first row of each range also ends the range before it.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    kind, n = rows.schema["_key"].dataType, partitions(spark)
    # One bound and one number a range go through the driver, none of the rows.
    points = F.array(*[F.lit(i / n) for i in range(1, max(n, 2))])
    found = rows.agg(F.percentile_approx("_key", points, F.lit(20 * n)).alias("p")).first()["p"]
    dealt = rows.withColumn("_range", _range_number(F.col("_key"), sorted(set(found or [])), kind).cast("int"))
    dealt = dealt.withColumn("_tail", F.lit(False))
    # The first row of each range: its least key, and the least text that has it; nulls come first.
    least = dealt.groupBy("_range").agg(F.min(F.struct(F.col("_key").isNotNull().alias("_has"), F.col("_key"))).alias("_k"))
    least = F.broadcast(least.select(F.col("_range").alias("_r"), F.col("_k._key").alias("_first")))
    heads = dealt.join(least, (F.col("_range") == F.col("_r")) & F.col("_key").eqNullSafe(F.col("_first")))
    heads = heads.groupBy("_range", "_key").agg(F.min(F.coalesce("_text", F.lit(""))).alias("_text"))
    numbers = sorted(r[0] for r in dealt.select("_range").distinct().collect())
    before = {b: a for a, b in zip([*numbers[-1:], *numbers[:-1]], numbers)}
    to = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])[F.col("_range")] if before else F.lit(0)
    tails = heads.select("_key", "_text", to.cast("int").alias("_range"), F.lit(True).alias("_tail"))
    ordered = (
        dealt.unionByName(tails)
        .repartition(n, "_range")
        .sortWithinPartitions("_range", "_tail", "_key", F.coalesce("_text", F.lit("")))
    )
    schema = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_text", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )
    return ordered.mapInArrow(_pair_rows(key), schema)

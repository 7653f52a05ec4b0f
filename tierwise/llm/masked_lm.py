"""Masked pseudo-likelihood of texts under a small two-sided window network.

Words are hashed into input buckets and output buckets.  The network sees the two words before
and after a place, each through its embedding and a weight of its position, and gives the
probability of the word in between: first the upper half of its output bucket, then the lower
half given the upper, so probabilities add up to 1 over all buckets.  A table of all words of the
corpus gives the probability of a word inside its bucket: its share of the bucket's count, with
one more count for all words that were never seen.  The log-probabilities of all
words of a text, each from both sides, add up to the score of the text.

Training deals the places of every text to eight masks, and the masks to the rounds in turn, so
that every word is a training target in one round (of more than eight rounds, again).  Every partition trains on its
own words from the weights of the round before, and their weights are averaged by words, in
groups of bounded size until one is left, so what is gathered grows with the corpus.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tierwise.llm.frames import checkpointed
from tierwise.llm.words import Words, mix, slices, sorted_member, words_of

OFFSETS = (-2, -1, 1, 2)
BUCKETS, WIDTH, HALF = 8192, 16, 32
ROUNDS, MASKED, BATCH, RATE = 2, 8, 1024, 0.2
FAN_IN = 32
#: The most frequent words, up to so many, are looked up inside each task (16 bytes a word); only
#: the others are joined.
FEW_WORDS = 1 << 19

Weights = dict[str, np.ndarray]
_SHAPES = {
    "embed": (BUCKETS + 1, WIDTH),  # the last row stands for places outside the text
    "place": (len(OFFSETS), WIDTH),
    "upper": (WIDTH, HALF),
    "upper_bias": (HALF,),
    "lower": (WIDTH, HALF),
    "lower_bias": (HALF, HALF),  # by upper half
}


def initial(seed: int = 0, held: np.ndarray | None = None) -> Weights:
    """Weights as drawn; with ``held``, the words in each output bucket, biases start at their
    frequencies, so that training begins where the context is ignored."""
    random = np.random.default_rng(seed)
    out = {name: np.zeros(shape, np.float32) for name, shape in _SHAPES.items()}
    out["embed"] = random.normal(0, 0.3, _SHAPES["embed"]).astype(np.float32)
    out["place"] += 1.0
    if held is not None:
        share = (held + 1.0).reshape(HALF, HALF)
        out["upper_bias"] = np.log(share.sum(axis=1) / share.sum()).astype(np.float32)
        out["lower_bias"] = np.log(share / share.sum(axis=1, keepdims=True)).astype(np.float32)
    return out


def _flat(weights: Weights) -> np.ndarray:
    return np.concatenate([weights[name].reshape(-1) for name in _SHAPES])


def _unflat(flat: np.ndarray) -> Weights:
    out, at = {}, 0
    for name, shape in _SHAPES.items():
        n = math.prod(shape)
        out[name] = flat[at : at + n].reshape(shape).astype(np.float32)
        at += n
    return out


def _buckets(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input buckets, and upper and lower halves of output buckets, of all words."""
    inputs = (words.hashes % np.uint64(BUCKETS)).astype(np.int32)
    outputs = (mix(words.hashes, 0x3C6EF372) >> np.uint64(54)).astype(np.int32)
    return inputs, outputs >> 5, outputs & (HALF - 1)


def _padded(words: Words, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Input buckets with places outside the text on both sides of each text, and where each word stands there."""
    reach = max(OFFSETS)
    at = np.arange(len(inputs)) + reach * (words.text_of() + 1)
    out = np.full(len(inputs) + reach * len(words.first), BUCKETS, np.int32)
    out[at] = inputs
    return out, at


_STEPS = np.array(OFFSETS)[:, None]


def _hidden(weights: Weights, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hidden layer of each place, and the embeddings around it."""
    found = weights["embed"].take(around, axis=0)
    total = found[0] * weights["place"][0]
    for one, place in zip(found[1:], weights["place"][1:]):
        total += one * place
    return np.tanh(total, out=total), found


#: Scores of upper halves are the first HALF columns, those of lower ones the others; each column of
#: this adds up one half.
_BOTH = np.kron(np.eye(2, dtype=np.float32), np.ones((HALF, 1), np.float32))
#: Scores up to this size are raised to powers as they are, and others less the largest of a half.
_PLAIN = 40.0


def _sides(weights: Weights) -> tuple[np.ndarray, np.ndarray, bool]:
    """Weights of both halves, their biases by upper half, and whether all scores are small."""
    both = np.concatenate([weights["upper"], weights["lower"]], axis=1)
    bias = np.concatenate([np.broadcast_to(weights["upper_bias"], (HALF, HALF)), weights["lower_bias"]], axis=1)
    # The hidden layer lies between -1 and 1.
    most = np.abs(both).sum(axis=0).max() + np.abs(bias).max()
    return both, bias, bool(most <= _PLAIN)


def _raised(sides: tuple[np.ndarray, np.ndarray, bool], hidden: np.ndarray, upper: np.ndarray, lower: np.ndarray):
    """Powers of the scores of both halves, their sums by half, and the scores of the true halves."""
    both, bias, small = sides
    scores = hidden @ both
    scores += bias.take(upper, axis=0)
    if not small:
        for half in (scores[:, :HALF], scores[:, HALF:]):
            half -= half.max(axis=1, keepdims=True)
    true = _true(upper, lower)
    own = scores.reshape(-1).take(true)
    np.exp(scores, out=scores)
    return scores, scores @ _BOTH, own, true


def _true(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Where the true upper and lower half of each place stand among all scores."""
    row = np.arange(0, 2 * HALF * len(upper), 2 * HALF)
    return np.stack([row + upper, row + HALF + lower])


def place_scores(weights: Weights, words: Words, places: np.ndarray) -> np.ndarray:
    """Log-probability of the word at each place, given those around it."""
    inputs, upper, lower = _buckets(words)
    padded, stands = _padded(words, inputs)
    sides = _sides(weights)
    out = np.empty(len(places), np.float64)
    for i in range(0, len(places), 1 << 12):
        at = places[i : i + (1 << 12)]
        hidden, _ = _hidden(weights, padded.take(stands[at] + _STEPS))
        _, total, own, _ = _raised(sides, hidden, upper[at], lower[at])
        out[i : i + len(at)] = own.sum(axis=0) - np.log(total[:, 0]) - np.log(total[:, 1])
    return out


def _summed(at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different places, ascending, and the sum of the rows of each."""
    order = np.argsort(at.astype(np.uint16), kind="stable")  # there are few places: a radix sort
    at = at.take(order)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at.take(first), np.add.reduceat(rows.take(order, axis=0), first, axis=0)


def _step(weights: Weights, seen: Weights, around: np.ndarray, upper: np.ndarray, lower: np.ndarray, rate: float) -> None:
    """One step against the mean gradient of a batch, each weight at a rate that falls with the
    squares of its gradients so far, in ``seen``."""
    n = len(upper)
    hidden, found = _hidden(weights, around)
    sides = _sides(weights)
    slopes, total, _, true = _raised(sides, hidden, upper, lower)
    total *= n
    slopes[:, :HALF] /= total[:, :1]
    slopes[:, HALF:] /= total[:, 1:]
    slopes.reshape(-1)[true] -= np.float32(1 / n)
    back = slopes @ sides[0].T
    back *= 1 - hidden * hidden
    pulls = back[None] * weights["place"][:, None]
    spots, embed = _summed(around.reshape(-1), pulls.reshape(-1, WIDTH))
    halves, bias = _summed(upper, slopes[:, HALF:])
    both = hidden.T @ slopes
    moves = {
        "upper": (None, both[:, :HALF]),
        "lower": (None, both[:, HALF:]),
        "upper_bias": (None, np.ones(n, np.float32) @ slopes[:, :HALF]),
        "lower_bias": (halves, bias),
        "place": (None, np.einsum("ni,kni->ki", back, found)),
        "embed": (spots, embed),
    }
    for name, (at, slope) in moves.items():
        squares = slope * slope
        if at is None:
            squares += seen[name]
            seen[name][:] = squares
        else:
            squares += seen[name].take(at, axis=0)
            seen[name][at] = squares
        squares += np.float32(1e-6)
        np.sqrt(squares, out=squares)
        np.divide(slope, squares, out=squares)
        squares *= np.float32(rate)
        if at is None:
            weights[name] -= squares
        else:
            weights[name][at] = weights[name].take(at, axis=0) - squares


def _train(text: str, flat: np.ndarray, turn: int, rounds: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, seen = _unflat(flat), 0
        squares = {name: np.zeros(shape, np.float32) for name, shape in _SHAPES.items()}
        for batch in batches:
            for low, high in slices(batch, text):
                words = words_of(batch.column(text).slice(low, high - low))
                inputs, upper, lower = _buckets(words)
                # By the place inside its text, so that each word falls to one mask in all rounds.
                place = np.arange(len(inputs)) - np.repeat(words.first[:-1], words.counts)
                mask = (mix(words.hashes + place.astype(np.uint64), seed) % np.uint64(MASKED)).astype(np.int64)
                masked = np.flatnonzero((mask - turn) % min(rounds, MASKED) == 0)
                masked = masked[np.argsort(mix(masked.astype(np.uint64), seed + turn + 1))]
                padded, stands = _padded(words, inputs)
                for i in range(0, len(masked), BATCH):
                    at = masked[i : i + BATCH]
                    # A last small batch moves the weights less.
                    _step(weights, squares, padded.take(stands[at] + _STEPS), upper[at], lower[at], RATE * len(at) / BATCH)
                seen += len(masked)
        if seen:
            # Numbers of tasks are not known here; a digest of the weights spreads them over groups.
            blob = _flat(weights).astype(np.float32).tobytes()
            part = int.from_bytes(hashlib.blake2b(blob, digest_size=7).digest(), "big")
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([float(seen)]), pa.array([blob])],
                ["part", "words", "weights"],
            )

    return run


def _average(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # At most FAN_IN sets, give or take; in one order, so that sums do not depend on arrival.
    sets = sorted((n, blob) for batch in batches for n, blob in zip(batch.column("words").to_pylist(), batch.column("weights").to_pylist()))
    words = sum(n for n, _ in sets)
    if words:
        total = sum(np.frombuffer(blob, np.float32).astype(np.float64) * n for n, blob in sets)
        blob = (total / words).astype(np.float32).tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int64()), pa.array([words]), pa.array([blob])], ["part", "words", "weights"]
        )


def _averaged(trained: DataFrame, parts: int) -> np.ndarray | None:
    schema = "part long, words double, weights binary"
    while True:
        parts = math.ceil(parts / FAN_IN)
        trained = trained.withColumn("part", F.pmod(F.xxhash64("part"), F.lit(parts))).groupBy("part").applyInArrow(_average, schema)
        if parts == 1:
            row = trained.first()
            return None if row is None else np.frombuffer(row["weights"], np.float32)


def bucket_words(counts: DataFrame) -> np.ndarray:
    """Words of the corpus in each output bucket, one row a bucket."""
    held = np.zeros(HALF * HALF)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        held[row["bucket"]] = row["n"]
    return held


def fit(docs: DataFrame, text: str = "text", rounds: int = ROUNDS, seed: int = 0, counts: DataFrame | None = None) -> Weights:
    """Weights trained on all words of all texts; the driver holds one set of weights at a time.

    ``counts`` is from ``word_counts`` and is worked out if not given.  Null and empty texts teach
    nothing; without any word the weights stay as they start.
    """
    weights = initial(seed, bucket_words(word_counts(docs, text) if counts is None else counts))
    own = docs.select(F.col(text))
    parts = own.rdd.getNumPartitions()
    for turn in range(rounds):
        trained = own.mapInArrow(_train(text, _flat(weights), turn, rounds, seed), "part long, words double, weights binary")
        flat = _averaged(trained, max(1, parts))
        if flat is not None:
            weights = _unflat(flat)
    return weights


def _counted(text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch, text):
                hashes, n = np.unique(words_of(batch.column(text).slice(low, high - low)).hashes, return_counts=True)
                _, upper, lower = _buckets(Words(hashes, np.array([0, len(hashes)])))
                columns = [pa.array(hashes.view(np.int64)), pa.array(upper * HALF + lower, pa.int32()), pa.array(n, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["word", "bucket", "n"])

    return run


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``word, bucket, n``: how often each word, by its hash, stands in all texts, and its output bucket."""
    counted = docs.select(F.col(text)).mapInArrow(_counted(text), "word long, bucket int, n long")
    return checkpointed(counted.groupBy("word", "bucket").agg(F.sum("n").alias("n")))


@dataclass
class Shares:
    """Logarithms of a word's share of its bucket: the frequent ones, and that of any unseen word."""

    words: np.ndarray
    logs: np.ndarray
    unseen: np.ndarray

    def inside(self, words: Words) -> tuple[np.ndarray, pa.Array]:
        """The sum over each text's frequent words, and its other words with how often each stands there."""
        place, known = sorted_member(words.hashes, self.words)
        logs = np.zeros(len(known))
        logs[known] = self.logs[place[known]]
        total, full = np.zeros(len(words.first) - 1), np.flatnonzero(words.counts)
        if len(full):
            total[full] = np.add.reduceat(logs, words.first[:-1][full])
        text, hashes = words.text_of()[~known], words.hashes[~known]
        order = np.lexsort((hashes, text))
        text, hashes = text[order], hashes[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
        at = np.flatnonzero(new)
        times, text, hashes = np.diff(at, append=len(text)), text[at], hashes[at]
        _, upper, lower = _buckets(Words(hashes, np.array([0, len(hashes)])))
        fields = [pa.array(hashes.view(np.int64)), pa.array(times, pa.int64()), pa.array(self.unseen[upper * HALF + lower])]
        rows = pa.StructArray.from_arrays(fields, ["word", "times", "none"])
        return total, pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(words.first))), pa.int32()), rows)


def frequent_shares(counts: DataFrame) -> tuple[Shares, int | None]:
    """Shares of the most frequent words, FEW_WORDS at most, and the least count among them; None
    if no other word is left."""
    held = bucket_words(counts)
    # How many words have each count: as many rows as there are different counts.
    sizes = sorted(((r["n"], r["words"]) for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()), reverse=True)
    total, least = 0, None
    for n, words in sizes:
        total += words
        if total > FEW_WORDS:
            least = n + 1
            break
    chosen = (counts if least is None else counts.where(F.col("n") >= least)).toArrow()
    words = chosen.column("word").to_numpy().view(np.uint64)
    logs = np.log(chosen.column("n").to_numpy()) - np.log(held[chosen.column("bucket").to_numpy()] + 1)
    order = np.argsort(words)
    return Shares(words[order], logs[order], -np.log(held + 1)), least


def score_words(docs: DataFrame, weights: Weights, counts: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, log_prob, mean_log_prob`` for each row, as ``score``, over words and not buckets.

    ``counts`` is from ``word_counts``.  All words that it lacks share one count of their bucket.
    Frequent words are looked up in the task that scores the text; the others are joined.
    """
    shares, least = frequent_shares(counts)
    scored = score(docs, weights, key, text, shares)
    if least is None:
        # No word is left to join, so what is not frequent was never counted.
        rest = F.aggregate(_WORDS, F.lit(0.0), lambda total, w: total + w["times"] * w["none"])
        total = scored.select(key, "n_tokens", (F.col("log_prob") + rest).alias("log_prob"))
    else:
        scored = checkpointed(scored.withColumn(_ROW, F.monotonically_increasing_id()))
        held = counts.groupBy("bucket").agg(F.sum("n").alias("_all"))  # a row a bucket
        others = counts.where(F.col("n") < least).join(F.broadcast(held), "bucket")
        others = others.select("word", (F.log("n") - F.log(F.col("_all") + 1)).alias("_share"))
        each = scored.select(_ROW, F.inline(_WORDS)).join(others, "word", "left")
        inside = each.groupBy(_ROW).agg(F.sum(F.col("times") * F.coalesce("_share", "none")).alias("_inside"))
        total = scored.join(inside, _ROW, "left")
        total = total.select(key, "n_tokens", (F.col("log_prob") + F.coalesce("_inside", F.lit(0.0))).alias("log_prob"))
    return total.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))


_ROW, _WORDS = "__tierwise_row", "__tierwise_words"


def score(
    docs: DataFrame, weights: Weights, key: str = "doc_id", text: str = "text", shares: Shares | None = None
) -> DataFrame:
    """``key, n_tokens, log_prob, mean_log_prob`` for each row, over its whole text; no shuffle.

    ``log_prob`` sums the conditional log-probabilities of the buckets of all words; with
    ``shares`` those of frequent words inside their buckets too, and one more column has the text's
    other words.  A null or empty text has no words: its sum is 0 and its mean null.  A text of one
    word is predicted from nothing.
    """
    own = docs.select(F.col(key), F.col(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch, text):
                part = batch.slice(low, high - low)
                words = words_of(part.column(text))
                logs = place_scores(weights, words, np.arange(len(words.hashes)))
                counts, total = words.counts, np.zeros(high - low)
                full = np.flatnonzero(counts)
                if len(full):
                    total[full] = np.add.reduceat(logs, words.first[:-1][full])
                others = []
                if shares is not None:
                    inside, left = shares.inside(words)
                    total, others = total + inside, [left]
                mean = pa.array(np.where(counts > 0, total / np.maximum(counts, 1), 0.0), mask=counts == 0)
                columns = [part.column(key), pa.array(counts, pa.int64()), pa.array(total), mean, *others]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType(
        [
            own.schema[key],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("log_prob", T.DoubleType()),
            T.StructField("mean_log_prob", T.DoubleType()),
        ]
    )
    if shares is not None:
        word = T.StructType().add("word", "long").add("times", "long").add("none", "double")
        schema.add(_WORDS, T.ArrayType(word))
    names = schema.names
    return own.mapInArrow(run, schema)

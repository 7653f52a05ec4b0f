"""Secrets in text: fixed patterns, and a character convolutional network over all other candidates.

A candidate is a run of characters that keys are made of, unless it looks like a plain word.  The
network reads the whole candidate with the characters around it: an embedding for each character,
one for its place inside and one for outside, a convolution, the greatest answer of each filter
over the candidate, and a logistic layer.  It learns from candidates that a pattern found against
those that none found; half of the time a finding is seen without the words its pattern goes by, so
that the network learns the look of a key and not only the word before it.  Both passes are numpy over all candidates of a batch, laid
end to end.

Rows with an id hash of 2 in 4 teach nothing.  Over all their candidates the scores are calibrated
(a logistic fit to their histogram), findings by their score without those words, and of the
thresholds that keep the wanted recall of findings that with the greatest precision is taken.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.llm.frames import checkpointed
from tierwise.llm.words import slices

#: Kinds in the order in which spans of one start are written; the network's own come last.
KINDS = ("assign", "access", "hex", "network")
#: Fixed patterns, each found leftmost and without overlap; the lengths hold afterwards.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGNED = 6

#: Runs that may be keys.
RUN = re.compile(r"[A-Za-z0-9+/_=-](?:[A-Za-z0-9+/_.=-]{6,}[A-Za-z0-9+/_=-])")
_WORD = re.compile(r"[A-Za-z]?[a-z]*|[A-Z]+")
#: A run that is one plain word is a candidate from this length on.
LONG = 24
#: Characters read on each side of a candidate.
AROUND = 24

#: Examples of each answer that are learned from, at most; Spark cuts to so few before the shuffle.
SAMPLE_ROWS = 1000
WIDTH, REACH, FILTERS = 8, 5, 24
PASSES, BATCH, RATE = 6, 64, 0.01
#: Share of held-out pattern findings that the threshold keeps.
RECALL = 0.95
#: Bins of the held-out scores.
BINS = 512
#: Symbols that are convolved together.
TOGETHER = 1 << 17
_SYMBOLS = 98  # printable ASCII, white space, other ASCII, anything else, and a gap
GAP = _SYMBOLS - 1


def _symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    out = points - 33
    out[(points < 33) | (points == 127)] = 95
    out[(points == 32) | ((points >= 9) & (points <= 13))] = 94
    out[points > 127] = 96
    return out


def base_spans(text: str) -> list[tuple[int, int, int, int]]:
    """``(start, kind, end, value)`` of the pattern findings of a text, in order.

    Ends are exclusive; the key itself stands from ``value`` to the end.
    """
    found = [(m.start(), 0, m.end(), m.start(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGNED]
    found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m.start()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int, bool]]:
    """``(before, start, end, found)`` of all candidates: the keys that patterns found, and all runs
    that may be keys and overlap no pattern's span.  What the pattern goes by is from ``before`` on."""
    own: dict[tuple[int, int], int] = {}
    for start, _, end, value in base:
        own[value, end] = min(start, own.get((value, end), start))
    for (start, end), before in own.items():
        yield before, start, end, True
    at = 0
    ends = np.maximum.accumulate([end for _, _, end, _ in base]).tolist() if base else []
    for m in RUN.finditer(text):
        start, end = m.span()
        if end - start < LONG and _WORD.fullmatch(m.group()):
            continue
        while at < len(base) and ends[at] <= start:
            at += 1
        if at == len(base) or base[at][0] >= end:
            yield start, start, end, False


@dataclass
class CharNetwork:
    """Weights; ``embed`` has each symbol outside and inside a candidate."""

    embed: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def drawn(cls, seed: int = 0) -> CharNetwork:
        r = np.random.default_rng(seed)
        return cls(
            r.normal(0, 0.3, (2 * _SYMBOLS, WIDTH)),
            r.normal(0, 0.3, (REACH, WIDTH, FILTERS)),
            np.zeros(FILTERS),
            r.normal(0, 0.3, FILTERS),
            np.zeros(1),
        )

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.filter_bias, self.out, self.out_bias]

    def _convolved(self, symbols: np.ndarray) -> np.ndarray:
        # A convolution over embeddings is a sum of one table for each offset; outside is a gap.
        edge = REACH // 2
        wide = np.concatenate([np.full(edge, GAP), symbols, np.full(edge, GAP)])
        total = np.tile(self.filter_bias, (len(symbols), 1))
        for k in range(REACH):
            total += (self.embed @ self.filters[k])[wide[k : k + len(symbols)]]
        return total

    def strongest(self, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The greatest answer of each filter over each of the candidates laid end to end."""
        return np.maximum(np.maximum.reduceat(self._convolved(symbols), first, axis=0), 0.0)

    def strongest_of_long(self, symbols: np.ndarray) -> np.ndarray:
        """The same for one candidate, piece by piece."""
        out, edge = np.zeros(FILTERS), REACH // 2
        for begin in range(0, len(symbols), TOGETHER):
            low, high = max(0, begin - edge), min(len(symbols), begin + TOGETHER + edge)
            own = self._convolved(symbols[low:high])[begin - low : begin - low + TOGETHER]
            out = np.maximum(out, own.max(axis=0))
        return out

    def score(self, strong: np.ndarray) -> np.ndarray:
        """Log odds."""
        return strong @ self.out + self.out_bias[0]

    def gradients(self, symbols: np.ndarray, first: np.ndarray, found: np.ndarray) -> list[np.ndarray]:
        """Of the mean loss, one array for each of ``weights``."""
        answers = self._convolved(symbols)
        strong = np.maximum(np.maximum.reduceat(answers, first, axis=0), 0.0)
        score = self.score(strong)
        off = (1 / (1 + np.exp(-np.clip(score, -30, 30))) - found) / len(found)
        back = np.where(strong > 0, off[:, None] * self.out, 0.0)
        embed, filters = np.zeros_like(self.embed), np.zeros_like(self.filters)
        sizes = np.diff(first, append=len(symbols))
        edge = REACH // 2
        wide = np.concatenate([np.full(edge, GAP), symbols, np.full(edge, GAP)])
        hit = answers == np.repeat(strong, sizes, axis=0)
        for f in range(FILTERS):
            places = np.flatnonzero(hit[:, f])
            owner = np.searchsorted(first, places, "right") - 1
            owner, once = np.unique(owner, return_index=True)  # the first of equal answers
            places, pull = places[once], back[owner, f]
            for k in range(REACH):
                seen = wide[places + k]
                filters[k, :, f] += pull @ self.embed[seen]
                np.add.at(embed, seen, pull[:, None] * self.filters[k, :, f])
        return [embed, filters, back.sum(axis=0), strong.T @ off, np.array([off.sum()])]


def encoded(text: str, before: int, start: int, end: int) -> np.ndarray:
    """Symbols of a candidate and its surroundings, those up to ``before`` and from the end on."""
    gap = np.full(REACH // 2, GAP)
    around = (_symbols(text[max(0, before - AROUND) : before]), _symbols(text[end : end + AROUND]))
    return np.concatenate([gap, around[0], _symbols(text[start:end]) + _SYMBOLS, around[1], gap])


def train(examples: list[tuple[str, int, int, int, bool]], seed: int = 0) -> CharNetwork:
    """Fits a network to ``(text, before, start, end, found)``, with and without what is between."""
    net = CharNetwork.drawn(seed)
    if not examples:
        return net
    rows = [(encoded(t, b, start, end), found) for t, before, start, end, found in examples for b in (before, start)]
    random = np.random.default_rng(seed)
    # Adam's running means of gradients and of their squares.
    means = [(np.zeros_like(w), np.zeros_like(w)) for w in net.weights()]
    step = 0
    for _ in range(PASSES):
        order = random.permutation(len(rows))
        for begin in range(0, len(order), BATCH):
            chosen = [rows[i] for i in order[begin : begin + BATCH]]
            symbols = np.concatenate([s for s, _ in chosen])
            first = np.cumsum([0, *[len(s) for s, _ in chosen[:-1]]])
            step += 1
            for w, g, (m, v) in zip(net.weights(), net.gradients(symbols, first, np.array([f for _, f in chosen], float)), means):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def score_all(net: CharNetwork, rows: list[np.ndarray]) -> np.ndarray:
    """Scores of encoded candidates, worked out in pieces of bounded size."""
    strong, begin = np.zeros((len(rows), FILTERS)), 0
    while begin < len(rows):
        end, size = begin, 0
        while end < len(rows) and size + len(rows[end]) <= TOGETHER:
            size += len(rows[end])
            end += 1
        if end == begin:
            strong[begin] = net.strongest_of_long(rows[begin])
            end += 1
        else:
            first = np.cumsum([0, *[len(s) for s in rows[begin : end - 1]]])
            strong[begin:end] = net.strongest(np.concatenate(rows[begin:end]), first)
        begin = end
    return net.score(strong)


def held_out(key: Column) -> Column:
    return F.coalesce(F.pmod(F.xxhash64(key.cast("string")), F.lit(4)) == 2, F.lit(False))


_FOUND = "key_hash long, context string, before int, start int, stop int, found boolean"
_FOUND_NAMES = ["key_hash", "context", "before", "start", "stop", "found"]


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates with their surroundings, each answer's share of least hash in a batch."""
    for batch in batches:
        for low, high in slices(batch, "text"):
            part = batch.slice(low, high - low)
            rows: dict[bool, list] = {True: [], False: []}
            for key, text in zip(part.column("key_hash").to_pylist(), part.column("text").to_pylist()):
                for before, a, b, found in candidates(text, base_spans(text)):
                    begin = max(0, before - AROUND)
                    digest = hashlib.blake2b(f"{key}:{a}".encode(), digest_size=8).digest()
                    order = int.from_bytes(digest, "big", signed=True)
                    rows[found].append((order, text[begin : b + AROUND], before - begin, a - begin, b - begin, found))
            # More than the sample of one batch can never be needed.
            kept = [x for own in rows.values() for x in sorted(own)[:SAMPLE_ROWS]]
            columns = list(zip(*kept)) or [()] * 6
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _FOUND_NAMES)


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", sample_rows: int = SAMPLE_ROWS, seed: int = 0) -> CharNetwork:
    """A network trained on ``sample_rows`` candidates of each answer at most, those of least hash.

    Candidates of held-out rows teach nothing.  Of candidates with equal surroundings one is used.
    """
    own = docs.where(F.col(text).isNotNull() & ~held_out(F.col(key)))
    own = own.select(F.xxhash64(key).alias("key_hash"), F.col(text).alias("text"))
    found = own.mapInArrow(_examples, _FOUND)
    order = Window.partitionBy("found").orderBy("key_hash", "context", "start")
    first = found.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= min(sample_rows, SAMPLE_ROWS))
    rows = first.select("context", "before", "start", "stop", "found").collect()  # bounded by the sample
    return train([tuple(r) for r in sorted(set(map(tuple, rows)))], seed)


@dataclass
class Calibration:
    """Probability ``1 / (1 + exp(-(slope * score + shift)))``, and the least that is reported."""

    slope: float
    shift: float
    threshold: float

    def probability(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.asarray(score) + self.shift, -700, 700)))


def calibrate(scores: np.ndarray, right: np.ndarray, wrong: np.ndarray, recall: float = RECALL) -> Calibration:
    """From counts of pattern findings and of other candidates at ascending scores.

    Of all thresholds that keep ``recall`` of the findings the one of greatest precision is
    taken, of equal ones the least, which keeps most.  Without findings nothing is reported.
    """
    if not right.sum():
        return Calibration(1.0, 0.0, math.inf)
    # Logistic fit by Newton steps, each side with a half count more at the mean.
    slope, shift = 1.0, 0.0
    weight = right + wrong
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * scores + shift, -30, 30)))
        off, curve = weight * p - right, weight * p * (1 - p) + 1e-9
        g = np.array([(off * scores).sum() + 1e-3 * (slope - 1), off.sum() + 1e-3 * shift])
        h = np.array([[(curve * scores * scores).sum() + 1e-3, (curve * scores).sum()], [(curve * scores).sum(), curve.sum() + 1e-3]])
        move = np.linalg.solve(h, g)
        slope, shift = slope - np.clip(move[0], -1, 1), shift - np.clip(move[1], -1, 1)
        if np.abs(move).max() < 1e-9:
            break
    slope = max(slope, 1e-6)
    kept, other = right[::-1].cumsum()[::-1], wrong[::-1].cumsum()[::-1]
    allowed = np.flatnonzero(kept >= recall * right.sum())
    precision = kept[allowed] / (kept[allowed] + other[allowed])
    best = allowed[int(precision.argmax())]
    threshold = float(Calibration(slope, shift, 0.0).probability(scores[best]))
    return Calibration(float(slope), float(shift), threshold)


_SCALE = 16.0


def _bins(score: np.ndarray) -> np.ndarray:
    """Bins of scores from -16 to 16, those beyond in the outer ones."""
    return np.clip(((score + _SCALE) * (BINS / (2 * _SCALE))).astype(np.int64), 0, BINS - 1)


def _scored(net: CharNetwork):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch, "text"):
                yield scored(batch.slice(low, high - low))

    def scored(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans, others = [], []
        owner, rows, places = [], [], []
        for i, text in enumerate(batch.column("text").to_pylist()):
            base = base_spans(text or "")
            spans.append([{"start": a, "kind": k, "stop": b} for a, k, b, _ in base])
            others.append([])
            for before, a, b, found in candidates(text or "", base):
                owner.append(i)
                # What a pattern found counts as a key that it missed would look: without the words
                # that the pattern goes by.
                rows.append(encoded(text, before, a, b))
                places.append((a, b, found))
        score = score_all(net, rows)
        for i, (a, b, found), s, n in zip(owner, places, score.tolist(), _bins(score).tolist()):
            others[i].append({"start": a, "stop": b, "found": found, "score": s, "bin": n})
        columns = [batch.column("key"), batch.column("held_out"), pa.array(spans, _SPANS), pa.array(others, _OTHERS)]
        return pa.RecordBatch.from_arrays(columns, ["key", "held_out", "base", "others"])

    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("stop", pa.int64())]))
_OTHERS = pa.list_(
    pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("found", pa.bool_()), ("score", pa.float64()), ("bin", pa.int64())])
)
_SPAN_TYPES = (
    "base array<struct<start:long,kind:long,stop:long>>, "
    "others array<struct<start:long,stop:long,found:boolean,score:double,bin:long>>"
)


def scan(docs: DataFrame, net: CharNetwork, key: str = "doc_id", text: str = "text", recall: float = RECALL) -> tuple[DataFrame, Calibration]:
    """``key, findings`` for each row, and the calibration.

    ``findings`` are spans as ``start, kind, stop, probability`` by start, then kind, in code points with the
    end exclusive; ``kind`` is one of ``KINDS`` and the probability of a pattern's own span 1.
    The network only adds spans that overlap none of a pattern.  Null and empty texts have none;
    repeated rows stay, null keys too, and other columns are not looked at.  Texts are looked at
    once; their candidates are written to the shared folder.
    """
    own = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), held_out(F.col(key)).alias("held_out"))
    kind = docs.schema[key].dataType.simpleString()
    found = checkpointed(own.mapInArrow(_scored(net), f"key {kind}, held_out boolean, {_SPAN_TYPES}"))
    counts = found.where("held_out").select(F.inline("others")).groupBy("bin")
    counts = counts.agg(F.count_if("found").alias("right"), F.count_if(~F.col("found")).alias("wrong")).collect()  # a row a bin
    right, wrong = np.zeros(BINS), np.zeros(BINS)
    for row in counts:
        right[row["bin"]], wrong[row["bin"]] = row["right"], row["wrong"]
    middle = -_SCALE + (np.arange(BINS) + 0.5) * (2 * _SCALE / BINS)
    calibration = calibrate(middle, right, wrong, recall)
    kinds = F.array(*map(F.lit, KINDS))
    # The threshold is that of a bin's middle, and so is a candidate's probability.
    score = lambda o: F.lit(-_SCALE) + (o["bin"] + 0.5) * (2 * _SCALE / BINS)
    chance = lambda o: 1 / (1 + F.exp(-(score(o) * calibration.slope + calibration.shift)))
    added = F.filter("others", lambda o: ~o["found"] & (chance(o) >= F.lit(calibration.threshold) - 1e-12))
    rows = F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("n"), s["stop"].alias("stop"), F.lit(1.0).alias("probability"))),
        F.transform(added, lambda o: F.struct(o["start"].alias("start"), F.lit(3).cast("long").alias("n"), o["stop"].alias("stop"), chance(o).alias("probability"))),
    )
    named = F.transform(
        F.array_sort(rows),
        lambda s: F.struct(s["start"].alias("start"), F.get(kinds, s["n"].cast("int")).alias("kind"), s["stop"].alias("stop"), s["probability"].alias("probability")),
    )
    return found.select(F.col("key").alias(key), named.alias("findings")), calibration


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of findings, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")

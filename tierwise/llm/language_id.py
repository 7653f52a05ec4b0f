"""Language identification by unigram pieces, summed over all segmentations.

Pieces are those of a fixed public vocabulary; each language has its own piece probabilities,
fitted by expectation maximisation on a bounded sample of labelled rows.  The probability of a
word is the sum over all ways to cut it into pieces, found by the forward algorithm, and that of
a text is the product over its words.  Words are scored once per batch, whole texts always.  Short
words are worked out side by side; a long one, such as a text without spaces, place by place with
sums that are scaled on the way, so that its length is not limited.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.llm.frames import word_array
from tierwise.llm.words import buffers, mix, slices, words_of

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: Labelled rows a language that are learned from, at most.
SAMPLE_ROWS = 400
ROUNDS = 3
SMOOTHING = 0.1
#: Characters of a piece, at most.
LONGEST_PIECE = 32
#: Words up to here, with their mark, have probabilities that a double holds; longer ones are scaled.
SHORT_WORD = 33
#: Places of a long word whose pieces are looked up together.
STRETCH = 1 << 15
UNDETERMINED = "und"
#: Words a task remembers before it starts anew, and words that are scored together.
REMEMBERED, TOGETHER = 1 << 19, 1 << 12
_OPEN = "▁"  # marks the beginning of a word in the vocabulary


def read_pieces(path: str = VOCABULARY) -> list[str]:
    """Lower-case pieces of a vocabulary file, without its bytes and control pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = [model.id_to_piece(i) for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    return sorted({p.lower() for p in plain if 0 < len(p.lower()) <= LONGEST_PIECE})


def _points(words: Sequence[str], size: int) -> np.ndarray:
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat.reshape(len(words), size).astype(np.uint64)


def _roll(hashed: np.ndarray, point: np.ndarray) -> np.ndarray:
    return mix(hashed * np.uint64(3) + point, 0x1F83D9AB)


def _by_size(words: Sequence[str]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        yield int(size), np.flatnonzero(sizes == size)


@dataclass
class LanguageModel:
    """Piece log-probabilities, one column a language; the last row is any unknown character."""

    pieces: list[str]
    languages: list[str]
    prob: np.ndarray
    _hashes: np.ndarray = field(init=False, repr=False)
    _rows: np.ndarray = field(init=False, repr=False)
    _longest: int = field(init=False, repr=False)

    def __post_init__(self):
        self._longest = max(map(len, self.pieces), default=1)
        hashes = np.zeros(len(self.pieces), np.uint64)
        for size, at in _by_size(self.pieces):
            points = _points([self.pieces[i] for i in at], size)
            h = np.zeros(len(at), np.uint64)
            for k in range(size):
                h = _roll(h, points[:, k])
            hashes[at] = h
        self._rows = np.argsort(hashes)
        self._hashes = hashes[self._rows]

    def _piece_rows(self, points: np.ndarray, begin: int) -> Iterator[tuple[int, np.ndarray]]:
        """End and piece row for all pieces that begin at a place; -1 where there is none."""
        h = np.zeros(len(points), np.uint64)
        for end in range(begin, min(points.shape[1], begin + self._longest)):
            h = _roll(h, points[:, end])
            at = np.searchsorted(self._hashes, h)
            at[at == len(self._hashes)] = 0
            row = np.where(self._hashes[at] == h, self._rows[at], -1)
            if end == begin:  # every single character can be passed
                row[row < 0] = len(self.pieces)
            yield end + 1, row

    def word_scores(self, words: Sequence[str], prob: np.ndarray | None = None, counts: np.ndarray | None = None):
        """Log-probability of each word a language; with ``counts``, expected piece counts instead."""
        prob = self.prob if prob is None else prob
        many = prob.shape[1]
        table = np.vstack([prob, np.zeros((1, many))])  # row -1: no piece
        out, expected = np.zeros((len(words), many)), np.zeros_like(prob)
        for size, all_at in _by_size(words):
            if size > SHORT_WORD:
                for i in all_at.tolist():
                    points = _points([words[i]], size)[0]
                    if counts is None:
                        out[i] = self._long_score(points, table)
                    else:
                        self._long_counts(points, table, counts[i], expected)
                continue
            for at in np.array_split(all_at, -(-len(all_at) // TOGETHER)):
                points = _points([words[i] for i in at], size)
                forward = [np.zeros((len(at), many)) for _ in range(size + 1)]
                forward[0][:] = 1.0
                seen = []
                for begin in range(size):
                    for end, row in self._piece_rows(points, begin):
                        use = np.flatnonzero(row >= 0)
                        if len(use):
                            forward[end][use] += forward[begin][use] * table[row[use]]
                            if counts is not None:
                                seen.append((begin, end, use, row[use]))
                if counts is None:
                    out[at] = np.log(forward[size])
                    continue
                backward = [np.zeros((len(at), many)) for _ in range(size + 1)]
                backward[size][:] = 1.0
                share = counts[at] / forward[size]
                for begin, end, use, row in reversed(seen):
                    part = table[row] * backward[end][use]
                    backward[begin][use] += part
                    part = part * forward[begin][use] * share[use]
                    for lang in range(many):
                        expected[:, lang] += np.bincount(row, part[:, lang], len(prob))
        return out if counts is None else expected

    def _pieces_at(self, points: np.ndarray) -> np.ndarray:
        """Row of the piece of each length (column) from each place; -1 where there is none."""
        n, width = len(points), min(self._longest, len(points))
        out = np.full((n, width), -1)
        h = np.zeros(n, np.uint64)
        for k in range(width):
            h = _roll(h[: n - k], points[k:])
            at = np.searchsorted(self._hashes, h)
            at[at == len(self._hashes)] = 0
            out[: n - k, k] = np.where(self._hashes[at] == h, self._rows[at], -1)
        out[out[:, 0] < 0, 0] = len(self.pieces)
        return out

    @staticmethod
    def _long_forward(table: np.ndarray, rows: np.ndarray, state: np.ndarray, scale: np.ndarray, logs: list | None = None):
        """Goes on from ``state``, the scaled sums of the places not done yet, over the pieces of ``rows``."""
        for begin in range(len(rows)):
            # The first of the open places is done: all pieces that end there were added.
            done = state[0].copy()
            scale = scale + np.log(done)
            if logs is not None:
                logs.append(scale)
            state /= done
            ends = rows[begin]
            state[1 : len(ends) + 1] += table[ends]
            state[:-1] = state[1:]
            state[-1] = 0.0
        return state, scale

    def _long_score(self, points: np.ndarray, table: np.ndarray) -> np.ndarray:
        """The sum over all segmentations of one word, a stretch of places at a time."""
        width = min(self._longest, len(points))
        state, scale = np.zeros((width + 1, table.shape[1])), np.zeros(table.shape[1])
        state[0] = 1.0
        for begin in range(0, len(points), STRETCH):
            rows = self._pieces_at(points[begin : begin + STRETCH + width])[:STRETCH]
            state, scale = self._long_forward(table, rows, state, scale)
        return scale + np.log(state[0])

    def _long_counts(self, points: np.ndarray, table: np.ndarray, count: np.ndarray, expected: np.ndarray) -> None:
        """Adds the expected pieces of one word, as often as it occurs, to ``expected``."""
        rows, many = self._pieces_at(points), table.shape[1]
        n, width = rows.shape
        start, logs = np.zeros((width + 1, many)), []
        start[0] = 1.0
        state, scale = self._long_forward(table, rows, start, np.zeros(many), logs)
        before, total = np.array(logs), scale + np.log(state[0])
        # From the end: the same sums over pieces that begin at a place.
        state, scale, after = np.zeros((width, many)), np.zeros(many), np.zeros((n + 1, many))
        state[0] = 1.0
        for begin in range(n - 1, -1, -1):
            own = (table[rows[begin]] * state).sum(axis=0)
            scale = scale + np.log(own)
            after[begin] = scale
            state[1:] = state[:-1] / own
            state[0] = 1.0
        begin, length = np.nonzero(rows >= 0)
        found = rows[begin, length]
        with np.errstate(divide="ignore"):
            part = np.log(table[found]) + before[begin] + after[begin + length + 1] - total
        part = np.exp(part) * count
        for lang in range(many):
            expected[:, lang] += np.bincount(found, part[:, lang], len(expected))


def held_out(key: Column) -> Column:
    """True where crc32 of the key as text leaves 2 when divided by 4; such rows teach nothing."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    vocabulary: str = VOCABULARY,
    sample_rows: int = SAMPLE_ROWS,
) -> LanguageModel:
    """Fits piece probabilities to rows with a text and a language that are not held out.

    At most ``sample_rows`` rows a language, those of least hash of the key, are learned from;
    their word counts come to the driver.  Without labelled rows the model has no language.
    """
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"), F.col(lang).alias("_l")).where(
        "_k is not null and _t is not null and _l is not null"
    )
    rows = rows.where(~held_out(F.col("_k"))).withColumn("_h", F.pmod(F.xxhash64("_k"), F.lit(1 << 20)))
    sizes = {r["_l"]: r["count"] for r in rows.groupBy("_l").count().collect()}
    languages = sorted(sizes)
    pieces = read_pieces(vocabulary)
    if not languages:
        return LanguageModel(pieces, [], np.zeros((len(pieces) + 1, 0)))
    # A first cut by the hash alone, then the exact number among the few rows left.
    cut = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, int((1 << 20) * min(1.0, 2 * sample_rows / n)) + 1)])
    order = Window.partitionBy("_l").orderBy("_h", "_k")
    sample = rows.where(F.col("_h") < cut[F.col("_l")]).withColumn("_n", F.row_number().over(order)).where(f"_n <= {sample_rows}")
    words = sample.select("_l", F.explode(word_array(F.lower("_t"))).alias("word")).groupBy("word", "_l").count()
    # Columns of Arrow and one matrix, not a row object for each word.
    found = words.toArrow()
    spelled = pc.dictionary_encode(found.column("word").combine_chunks())
    counts = np.zeros((len(spelled.dictionary), len(languages)))
    which = pc.index_in(found.column("_l"), pa.array(languages)).to_numpy()
    np.add.at(counts, (spelled.indices.to_numpy(), which), found.column("count").to_numpy())
    parts = [_OPEN + w for w in spelled.dictionary.to_pylist()]
    shape = (len(pieces) + 1, len(languages))
    model = LanguageModel(pieces, languages, np.full(shape, 1.0 / shape[0]))
    for _ in range(ROUNDS):
        expected = model.word_scores(parts, counts=counts) + SMOOTHING
        model.prob = expected / expected.sum(axis=0)
    return model


class _Scorer:
    """Scores texts and remembers the words it has seen."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.known = np.zeros(0, np.uint64)
        self.scores = np.zeros((0, len(model.languages)))

    def texts(self, column: pa.Array) -> np.ndarray:
        lower = pc.utf8_lower(pc.fill_null(column, ""))
        words = words_of(lower)
        out = np.zeros((len(column), len(self.model.languages)))
        if not len(words.hashes):
            return out
        unique, first, back = np.unique(words.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, unique)
        at[at == len(self.known)] = 0
        new = self.known[at] != unique if len(self.known) else np.ones(len(unique), bool)
        if new.any():
            self._learn(unique[new], self._spelled(lower, words.first, first[new]))
            at = np.searchsorted(self.known, unique)
        scores = self.scores[at][back]
        full = np.flatnonzero(words.counts)
        out[full] = np.add.reduceat(scores, words.first[:-1][full], axis=0)
        return out

    @staticmethod
    def _spelled(column: pa.Array, first: np.ndarray, places: np.ndarray) -> list[str]:
        data, offsets = buffers(column)
        raw, order = data.tobytes(), np.argsort(places)
        out: list[str] = [""] * len(places)
        text = np.searchsorted(first, places[order], "right") - 1
        words: list[bytes] = []
        open_text = -1
        for i, t in zip(order.tolist(), text.tolist()):
            if t != open_text:
                open_text, words = t, raw[offsets[t] : offsets[t + 1]].split()
            out[i] = words[places[i] - first[t]].decode("utf-8", "replace")
        return out

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        scores = self.model.word_scores([_OPEN + w for w in words])
        if len(self.known) > REMEMBERED:
            # Words of the batch at hand that were known are learned again when they are missed.
            self.known, self.scores = self.known[:0], self.scores[:0]
            raise _Forgot
        known = np.concatenate([self.known, hashes])
        order = np.argsort(known)
        self.known, self.scores = known[order], np.concatenate([self.scores, scores])[order]


class _Forgot(Exception):
    pass


def _predictor(model: LanguageModel) -> Callable[[Column], Column]:
    names = np.array([*model.languages, UNDETERMINED], dtype=object)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _Scorer(model)
        for batch in batches:
            parts = [predicted(scorer, batch.slice(low, high - low)) for low, high in slices(batch, limit=1 << 20)]
            yield pa.concat_arrays(parts) if parts else pa.array([], _PREDICTED)
        pa.default_memory_pool().release_unused()

    def predicted(scorer: _Scorer, column: pa.Array) -> pa.Array:
        lettered = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
        best, score = np.full(len(column), len(names) - 1), np.zeros(len(column))
        if model.languages:
            try:
                logs = scorer.texts(column)
            except _Forgot:
                logs = scorer.texts(column)
            chance = np.exp(logs - logs.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            best = np.where(lettered, logs.argmax(axis=1), best)
            score = np.where(lettered, chance.max(axis=1), 0.0)
        return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score)], fields=list(_PREDICTED))

    return F.arrow_udf(run, "lang_pred string, score double")


_PREDICTED = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])
#: The prediction on its way; no input column is called this.
_GUESS = "__tierwise_language"


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) with ``lang_pred`` and ``score``; no shuffle, whole texts.

    The language of greatest probability, with its share among all languages; equal shares go to
    the first in order.  A text that is null, empty or without a letter is ``und`` with score 0,
    as is every text of a model without languages.  Only the text is looked at, and only it goes
    through Python.  Input columns called ``lang_pred`` or ``score`` are replaced.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    guessed = docs.withColumn(_GUESS, _predictor(model)(F.col(text)))
    return guessed.select(*keep, f"{_GUESS}.lang_pred", f"{_GUESS}.score")


def keep_identified(docs: DataFrame, model: LanguageModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without those whose language is undetermined or less likely than ``least``."""
    guessed = docs.withColumn(_GUESS, _predictor(model)(F.col(text)))
    known = (F.col(f"{_GUESS}.lang_pred") != UNDETERMINED) & (F.col(f"{_GUESS}.score") >= least)
    return guessed.where(known).drop(_GUESS)

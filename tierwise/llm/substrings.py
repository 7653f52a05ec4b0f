"""Removal of passages that already start in a document with a smaller id.

Level-wise doubling.  The first level looks at windows of half the wanted length (7 words for
13), and only at the one with the least hash among those inside each full window, so equal
full windows always bring the same half.  Halves that repeat in no other document end there.
Windows around a repeated half are extended to twice that length, sharing a word where the
wanted length is odd, and compared again with two 64-bit hashes.  ``repeat_levels`` goes on
from there, doubling until no window repeats.

Documents are dealt into chunks of bounded size by a hash of their content.  A chunk sends each
distinct hash once, however often it holds it, so a passage in a third of all documents costs
one entry a chunk.  Entries meet in buckets by the leading bits of the hash, which are even.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tierwise.llm.frames import pieces, text_bytes
from tierwise.llm.words import Words, buffers, slices, sorted_member, words_of

CHUNK_BYTES = 8 << 20
NO_ID = np.iinfo(np.int64).max


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), NO_ID).to_numpy()


def _parts(table: pa.Table, text: str) -> Iterator[tuple[int, int, pa.Array]]:
    for low, high in slices(table, text):
        yield low, high, table.column(text).slice(low, high - low).combine_chunks()


def _least_halves(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a full window starts, and the least hash of the halves inside it."""
    half = (length + 1) // 2
    starts = np.flatnonzero(words.whole(length))
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    least, span, inside = words.windows(half), 1, length - half + 1
    while span < inside:
        step = min(span, inside - span)
        least = np.minimum(least[:-step], least[step:])
        span += step
    return starts, least[starts]


def _by_bucket(keys: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """Bucket, begin and end of its stretch, for keys in ascending order."""
    number = ((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    used, begin = np.unique(number, return_index=True)
    return list(zip(used.tolist(), begin.tolist(), [*begin[1:].tolist(), len(keys)]))


def _binary(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_HALVES = pa.schema([("bucket", pa.int32()), ("chunk", pa.int32()), ("keys", pa.binary()), ("many", pa.binary())])
_REPEATED = pa.schema([("chunk", pa.int32()), ("keys", pa.binary())])
_FULL = pa.schema(
    [
        ("bucket", pa.int32()),
        ("chunk", pa.int32()),
        ("a", pa.binary()),
        ("b", pa.binary()),
        ("first", pa.binary()),
        ("many", pa.binary()),
    ]
)
_FIRSTS = pa.schema([("chunk", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("first", pa.binary())])
_DDL = {
    "halves": "bucket int, chunk int, keys binary, many binary",
    "repeated": "chunk int, keys binary",
    "full": "bucket int, chunk int, a binary, b binary, first binary, many binary",
    "firsts": "chunk int, a binary, b binary, first binary",
}


def _send_halves(length: int, buckets: int, text: str):
    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys, owners = [], []
        for low, _, part in _parts(table, text):
            words = words_of(part)
            starts, least = _least_halves(words, length)
            owner = words.text_of()[starts] + low
            fresh = np.ones(len(least), bool)
            fresh[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
            keys.append(least[fresh])
            owners.append(owner[fresh])
        keys, owners = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in (keys, owners))
        order = np.argsort(keys, kind="stable")  # owners stay ascending inside a key
        keys, owners = keys[order], owners[order]
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        other = np.zeros(len(keys), bool)
        other[1:] = ~first[1:] & (owners[1:] != owners[:-1])
        at = np.flatnonzero(first)
        many = np.logical_or.reduceat(other, at) if len(at) else other
        keys = keys[at]
        return _rows(
            [(b, key[0].as_py(), _binary(keys[i:j]), _binary(many[i:j])) for b, i, j in _by_bucket(keys, buckets)],
            _HALVES,
        )

    return send


def _find_repeated(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For each chunk, those of its halves that other documents hold too."""
    blobs = table.column("keys").to_pylist()
    keys = np.concatenate([np.frombuffer(x, np.uint64) for x in blobs])
    many = np.concatenate([np.frombuffer(x, bool) for x in table.column("many").to_pylist()])
    value, back, count = np.unique(keys, return_inverse=True, return_counts=True)
    again = count > 1
    again[back[many]] = True
    keep, out, at = again[back], [], 0
    for chunk, blob in zip(table.column("chunk").to_pylist(), blobs):
        n = len(blob) // 8
        if (own := keys[at : at + n][keep[at : at + n]]).size:
            out.append((chunk, _binary(own)))
        at += n
    return _rows(out, _REPEATED)


def _send_full(length: int, buckets: int, text: str, key_column: str):
    def send(key: tuple[pa.Scalar, ...], docs: pa.Table, repeated: pa.Table) -> pa.Table:
        if not len(docs) or not len(repeated):
            return _rows([], _FULL)
        known = np.sort(np.concatenate([np.frombuffer(x, np.uint64) for x in repeated.column("keys").to_pylist()]))
        ids = _ids(docs.column(key_column))
        found = []
        for low, _, part in _parts(docs, text):
            words = words_of(part)
            starts, least = _least_halves(words, length)
            starts = starts[sorted_member(least, known)[1]]
            if len(starts):
                owner = words.text_of()[starts] + low
                found.append((words.windows(length)[starts], words_of(part, 1).windows(length, 1)[starts], ids[owner]))
        if not found:
            return _rows([], _FULL)
        a, b, owner = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((owner, b, a))
        a, b, owner = a[order], b[order], owner[order]
        first = np.ones(len(a), bool)
        first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        at = np.flatnonzero(first)
        many = np.maximum.reduceat(owner, at) > owner[at]  # the chunk has it under other ids too
        a, b, owner = a[at], b[at], owner[at]
        return _rows(
            [
                (n, key[0].as_py(), *(_binary(x[i:j]) for x in (a, b, owner, many)))
                for n, i, j in _by_bucket(a, buckets)
            ],
            _FULL,
        )

    return send


def _find_firsts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For each chunk, the smallest id that any chunk holds its full windows under, where that
    covers one of its own; of the second hash half is enough to tell those of one chunk apart."""
    chunks = table.column("chunk").to_pylist()
    sizes = [len(x) // 8 for x in table.column("a").to_pylist()]
    a, b = (np.concatenate([np.frombuffer(x, np.uint64) for x in table.column(c).to_pylist()]) for c in "ab")
    owner = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("first").to_pylist()])
    many = np.concatenate([np.frombuffer(x, bool) for x in table.column("many").to_pylist()])
    order = np.lexsort((owner, b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    least = np.empty_like(owner)
    least[order] = owner[order][new][np.cumsum(new) - 1]
    covers, half = many | (least < owner), _half(b)
    out, at = [], 0
    for chunk, n in zip(chunks, sizes):
        own = np.flatnonzero(covers[at : at + n]) + at
        if len(own):
            out.append((chunk, _binary(a[own]), _binary(half[own]), _binary(least[own])))
        at += n
    return _rows(out, _FIRSTS)


def _half(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(32)).astype(np.uint32)


def _covered(words: Words, part: pa.Array, length: int, owner: np.ndarray, firsts: tuple) -> np.ndarray:
    """True for words inside a window that starts in a document with a smaller id."""
    a, b, least = firsts
    starts = np.flatnonzero(words.whole(length))
    edge = np.zeros(len(words.hashes) + 1, np.int32)
    at, known = sorted_member(words.windows(length)[starts], a)
    starts, at = starts[known], at[known]
    if len(starts):
        strong = _half(words_of(part, 1).windows(length, 1)[starts])
        # Different windows with one first hash stand next to each other; look on while it is equal.
        own = a[at]
        while (off := (b[at] != strong) & (at + 1 < len(a)) & (a[np.minimum(at + 1, len(a) - 1)] == own)).any():
            at = at + off
        hit = (b[at] == strong) & (least[at] < owner[words.text_of()[starts]])
        np.add.at(edge, starts[hit], 1)
        np.add.at(edge, starts[hit] + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _cut(length: int, text: str, key_column: str, chunk_column: str, schema: pa.Schema):
    def cut(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        docs = docs.drop_columns([chunk_column])
        ids = _ids(docs.column(key_column))
        firsts = None
        if len(answers):
            kinds = (np.uint64, np.uint32, np.int64)
            parts = [
                np.concatenate([np.frombuffer(x, k) for x in answers.column(c).to_pylist()])
                for c, k in zip(("a", "b", "first"), kinds)
            ]
            order = np.lexsort((parts[1], parts[0]))
            firsts = tuple(x[order] for x in parts)
        n_words, n_removed, kept = [], [], []
        for low, high, part in _parts(docs, text):
            raw, offsets = buffers(part)
            data, gone, first = raw.tobytes(), None, None
            if firsts is not None:
                words = words_of(part)
                gone, first = _covered(words, part, length, ids[low:high], firsts), words.first
            for i in range(high - low):
                own = data[offsets[i] : offsets[i + 1]].split()
                removed = 0
                n_words.append(len(own))
                if gone is not None and (removed := int((hide := gone[first[i] : first[i + 1]]).sum())):
                    own = [own[k] for k in np.flatnonzero(~hide)]
                n_removed.append(removed)
                kept.append(b" ".join(own))
        docs = docs.append_column("n_words", pa.array(n_words, pa.int64()))
        docs = docs.append_column("n_removed", pa.array(n_removed, pa.int64()))
        docs = docs.append_column("kept_text", pa.array(kept, pa.binary()).cast(pa.string()))
        return docs.select(schema.names).cast(schema)

    return cut


def remove_repeated(docs: DataFrame, length: int = 13, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_removed`` and ``kept_text``, one row for each input row.

    A word goes if a window of ``length`` words over it also starts in a document with a smaller
    ``key``; the input decides, not what is left.  Kept words are joined by one space.  A null or
    empty text has no words and keeps the empty text.  Texts under ``length`` words lose nothing.
    Rows with an equal key count as one document: they do not remove each other's words.  A null
    key is larger than all others.  Other columns pass through; input columns with one of the
    three result names are replaced.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    chunk = "__chunk"
    docs = docs.drop("n_words", "n_removed", "kept_text", chunk)
    chunks = pieces(docs.sparkSession, text_bytes(docs, text), CHUNK_BYTES)
    dealt = docs.withColumn(chunk, F.pmod(F.xxhash64(key, text), F.lit(chunks)).cast("int"))
    out = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept_text", T.StringType()),
        ]
    )
    # The three readers of ``dealt`` are in one plan, so its texts are shuffled once.
    by_chunk = dealt.groupBy(chunk)
    halves = by_chunk.applyInArrow(_send_halves(length, chunks, text), _DDL["halves"])
    repeated = halves.groupBy("bucket").applyInArrow(_find_repeated, _DDL["repeated"])
    full = by_chunk.cogroup(repeated.groupBy("chunk")).applyInArrow(
        _send_full(length, chunks, text, key), _DDL["full"]
    )
    firsts = full.groupBy("bucket").applyInArrow(_find_firsts, _DDL["firsts"])
    return by_chunk.cogroup(firsts.groupBy("chunk")).applyInArrow(
        _cut(length, text, key, chunk, to_arrow_schema(out)), out
    )

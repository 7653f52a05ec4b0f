"""Near-duplicate documents by order MinHash and banded alignment.

A document is the sequence of its five-word shingles, each labelled with how often it came
before; words are lower-case runs between spaces and ASCII punctuation.  An entry of the sketch
takes the two labelled shingles of least hash and keeps them in text order, so it agrees only
where the same shingles come in the same order.  Two entries make a band.  In each band bucket
every text is compared with the bucket's least member, which is one comparison a member and not
all pairs.  Then, in each bucket whose texts are not one class yet, texts of different classes
meet in blocks of bounded size, so that all pairs with a common bucket are met or joined by a chain
of links.  Texts that agree in enough entries are aligned: shingles that both have
within a diagonal band are chained in order and the words between them aligned one by one, which
gives an edit distance.  Exact copies are one text throughout.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierwise.llm.blocks import meet_in_blocks
from tierwise.llm.components import components, extended
from tierwise.llm.frames import checkpointed
from tierwise.llm.skew import heavy_keys, spread_join
from tierwise.llm.words import MARKS, Words, mix, slices, words_of

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: 24 bands of two entries of two shingles.  Two texts that share 0.8 of their shingles miss all
#: bands with a chance of 0.59^24, about 3 in a million; at 0.7 of 1 in 700, at 0.6 of 1 in 28.
ENTRIES, BAND = 48, 2
#: Entries in which a pair must agree before it is aligned.  Of 48 about 30 agree at 0.8, 17 at 0.6
#: (deviation 3.3), so this loses fewer pairs than the bands do.
AGREE = 6
#: Share of pairs of 200 words that a given share of scattered word replacements leaves linked, as
#: measured; each replacement changes five shingles.
RECALL_BY_EDITS = {0.02: 1.0, 0.05: 0.98, 0.08: 0.73, 0.1: 0.5, 0.15: 0.1, 0.19: 0.01}


def _labelled(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of labelled shingles of all texts, and the offsets of each text's shingles.

    A text of one to four words has one shingle, made of all of them.
    """
    counts = words.counts
    per = np.where(counts >= SHINGLE_WORDS, counts - SHINGLE_WORDS + 1, (counts > 0).astype(np.int64))
    offsets = np.zeros(len(per) + 1, np.int64)
    np.cumsum(per, out=offsets[1:])
    out = np.zeros(offsets[-1], np.uint64)
    long = counts >= SHINGLE_WORDS
    whole = words.whole(SHINGLE_WORDS)
    out[np.repeat(long, per)] = words.windows(SHINGLE_WORDS)[whole]
    for i in np.flatnonzero((counts > 0) & ~long):
        own = Words(words.hashes[words.first[i] : words.first[i + 1]], np.array([0, counts[i]]))
        out[offsets[i]] = own.windows(int(counts[i]))[0]
    # Number repeats inside a text, in text order.
    owner = np.repeat(np.arange(len(per), dtype=np.uint64), per)
    inside = mix(owner, 0x51ED2701) ^ out
    order = np.argsort(inside, kind="stable")
    again = np.zeros(len(out), bool)
    if len(out) > 1:
        again[1:] = inside[order][1:] == inside[order][:-1]
    if again.any():
        at = np.arange(len(out))
        before = at - np.maximum.accumulate(np.where(again, 0, at))
        label = np.zeros(len(out), np.uint64)
        label[order] = before.astype(np.uint64)
        repeated = label > 0
        out[repeated] = mix(out[repeated] + label[repeated], 0x2545F491)
    return out, offsets


def _entries(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sketch of each text as 32-bit entries; all zero without shingles."""
    n = len(offsets) - 1
    out = np.zeros((n, ENTRIES), np.uint32)
    full = np.flatnonzero(np.diff(offsets) > 0)
    if not len(full):
        return out
    starts, sizes = offsets[full], np.diff(offsets)[full]
    single = sizes == 1
    for e in range(ENTRIES):
        order = mix(shingles, (e + 1) * 0x632BE59BD9B4E019 & (2**64 - 1))
        least = np.minimum.reduceat(order, starts)
        first = np.flatnonzero(order == np.repeat(least, sizes))
        if len(first) > len(full):  # equal labelled hashes inside one text
            first = first[np.unique(np.searchsorted(starts, first, "right"), return_index=True)[1]]
        order[first] = np.iinfo(np.uint64).max
        least = np.minimum.reduceat(order, starts)
        second = np.flatnonzero(order == np.repeat(least, sizes))
        if len(second) > len(full):
            second = second[np.unique(np.searchsorted(starts, second, "right"), return_index=True)[1]]
        second = np.where(single, first, second)
        left, right = np.minimum(first, second), np.maximum(first, second)
        out[full, e] = (mix(shingles[left] * np.uint64(3) + shingles[right], 0x9E3779B9) >> np.uint64(32)).astype(np.uint32)
    return out


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, high in slices(batch, "text"):
            part = batch.slice(low, high - low)
            entries = _entries(*_labelled(_normal_words(part.column("text"))))
            flat = pa.array(entries.reshape(-1).view(np.int32))
            sketch = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, ENTRIES, dtype=np.int32), flat)
            yield pa.RecordBatch.from_arrays([part.column("node"), part.column("id"), sketch], ["node", "id", "sketch"])


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Insertions, removals and replacements between two sequences; ``most + 1`` if there are more."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return most + 1
    at = np.arange(len(b) + 1)
    row = at.copy()
    for i, x in enumerate(a.tolist(), 1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (b != x), row[1:] + 1)
        row = np.minimum.accumulate(new - at) + at
        if row.min() > most:
            return most + 1
    return min(int(row[-1]), most + 1)


def _chain(places: list[int]) -> list[int]:
    """Indices of a longest ascending run."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for i, p in enumerate(places):
        k = bisect_left(tails, p)
        back.append(ends[k - 1] if k else -1)
        tails[k : k + 1] = [p]
        ends[k : k + 1] = [i]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def aligned_similarity(
    words_a: np.ndarray, a: np.ndarray, words_b: np.ndarray, b: np.ndarray, least: float = SIMILARITY
) -> float:
    """1 less the edits per word of the longer text, or 0 below ``least``.

    ``a`` and ``b`` are the labelled shingles.  A pair as similar as ``least`` has at most
    (1 - least) of the longer text as edits, and no alignment of it leaves that diagonal band.
    """
    longer = max(len(words_a), len(words_b))
    most = int((1 - least) * longer + 1e-9)
    if not len(a) or not len(b) or abs(len(words_a) - len(words_b)) > most:
        return 0.0
    # Every word of the longer text without an equal one in the other is an edit.
    (own, n), (others, m) = (np.unique(w, return_counts=True) for w in (words_a, words_b))
    _, i, j = np.intersect1d(own, others, assume_unique=True, return_indices=True)
    if longer - int(np.minimum(n[i], m[j]).sum()) > most:
        return 0.0
    order = np.argsort(b)
    at = np.searchsorted(b[order], a)
    at[at == len(b)] = 0
    place = order[at]
    hit = np.flatnonzero((b[place] == a) & (np.abs(place - np.arange(len(a))) <= most))
    if not len(hit):
        return 0.0
    place = place[hit]
    if (np.diff(place) <= 0).any():
        chain = _chain(place.tolist())
        hit, place = hit[chain], place[chain]
    # Runs of shingles one word apart in both texts are one stretch of equal words.
    cut = np.flatnonzero((np.diff(hit) != 1) | (np.diff(place) != 1)) + 1
    edits = end_a = end_b = 0
    size_a, size_b = min(SHINGLE_WORDS, len(words_a)), min(SHINGLE_WORDS, len(words_b))
    for i, j, n in [*zip(hit[[0, *cut]].tolist(), place[[0, *cut]].tolist(), np.diff([0, *cut, len(hit)]).tolist()), (None, None, 0)]:
        if i is None:
            i, j, stop_a, stop_b = len(words_a), len(words_b), len(words_a), len(words_b)
        else:
            stop_a, stop_b = i + n - 1 + size_a, j + n - 1 + size_b
            late = max(end_a - i, end_b - j, 0)  # the stretch may overlap the one before
            if late >= stop_a - i:
                continue
            i, j = i + late, j + late
        if i > end_a and j > end_b:
            edits += edit_distance(words_a[end_a:i], words_b[end_b:j], most - edits)
        else:
            edits += i - end_a + j - end_b
        if edits > most:
            return 0.0
        end_a, end_b = stop_a, stop_b
    return 1 - edits / longer


def _normal_words(column: pa.Array) -> Words:
    return words_of(pc.utf8_lower(column), gaps=MARKS)


def _align_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = None
    for batch in batches:
        center, member = batch.column("center"), batch.column("member")
        found = np.zeros(len(batch))
        for low, high in slices(batch, "member_text"):
            words = _normal_words(batch.column("member_text").slice(low, high - low))
            shingles, offsets = _labelled(words)
            for i in range(low, high):
                if known is None or known[0] != center[i].as_py():
                    own = _normal_words(batch.column("center_text").slice(i, 1))
                    known = (center[i].as_py(), own.hashes, _labelled(own)[0])
                k = i - low
                found[i] = aligned_similarity(
                    known[1],
                    known[2],
                    words.hashes[words.first[k] : words.first[k + 1]],
                    shingles[offsets[k] : offsets[k + 1]],
                )
        yield pa.RecordBatch.from_arrays([center, member, pa.array(found)], ["center", "member", "similarity"])


def _node(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _agreeing(a: str, b: str) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda total, one: total + one
    )


def _compare(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Similarity of ``pairs(center, member)``, which name texts by digest."""
    side = texts.select("node", "text")
    with_center = pairs.join(side.withColumnsRenamed({"node": "center", "text": "center_text"}), "center")
    both = with_center.join(side.withColumnsRenamed({"node": "member", "text": "member_text"}), "member")
    return both.select("center", "member", "center_text", "member_text").mapInArrow(
        _align_batches, "center binary, member binary, similarity double"
    )


def _met(members: DataFrame, sketch: DataFrame) -> DataFrame:
    """``bucket, center, member, near``: each member of a bucket with the bucket's least node, and
    whether their sketches agree."""
    sizes = members.groupBy("bucket").agg(F.min("node").alias("center"), F.max("node").alias("_last"), F.count(F.lit(1)).alias("_n"))
    least = checkpointed(sizes.where("center <> _last").drop("_last"))
    heavy = heavy_keys(least, "bucket", "_n")
    met = (
        spread_join(members, least.select("bucket", "center"), "bucket", heavy, ["node"])
        .where("node <> center")
        .select("bucket", "center", F.col("node").alias("member"))
        .join(sketch.withColumnsRenamed({"node": "center", "sketch": "_c"}), "center")
        .join(sketch.withColumnsRenamed({"node": "member", "sketch": "_m"}), "member")
    )
    return checkpointed(met.select("bucket", "center", "member", (_agreeing("_c", "_m") >= AGREE).alias("near")))


def _strangers(table: pa.Table, meetings: Iterator[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """Links between members of different labels; labels joined on the way do not meet again."""
    node = table.column("node").to_pylist()
    label = pc.dictionary_encode(table.column("label").combine_chunks()).indices.to_numpy().copy()
    sketch = table.column("sketch").combine_chunks().flatten().to_numpy().reshape(-1, ENTRIES)
    words = _normal_words(table.column("text").combine_chunks())
    counts, first = words.counts, words.first
    shingles, offsets = _labelled(words)
    band = sketch.reshape(len(sketch), -1, BAND)
    common = (band == band[0]).all(axis=(0, 2))  # the bucket's own band, rarely others too
    found = []
    for i, others in meetings:
        longer = np.maximum(counts[others], counts[i])
        # The difference in words is the least number of edits.
        fits = np.abs(counts[others] - counts[i]) <= (1 - SIMILARITY) * longer + 1e-9
        others = others[fits & (label[others] != label[i])]
        if not len(others):
            continue
        same = sketch[others] == sketch[i]
        # Two texts meet in the bucket of their first common band only.
        here = common[same.reshape(len(others), -1, BAND).all(axis=2).argmax(axis=1)]
        agree = same.sum(axis=1)
        near = np.flatnonzero(here & (agree >= AGREE))
        for k in others[near[np.argsort(-agree[near], kind="stable")]].tolist():
            if label[k] == label[i]:
                continue
            a, b = (slice(first[x], first[x + 1]) for x in (i, k))
            c, d = (slice(offsets[x], offsets[x + 1]) for x in (i, k))
            similarity = aligned_similarity(words.hashes[a], shingles[c], words.hashes[b], shingles[d])
            if similarity > 0:
                found.append((node[i], node[k], similarity))
                label[label == label[k]] = label[i]
    columns = list(zip(*found)) or [(), (), ()]
    kinds = (pa.binary(), pa.binary(), pa.float64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["a", "b", "similarity"])


def _mixed(met: DataFrame, labels: DataFrame) -> DataFrame:
    """``bucket, node, label, most`` of the buckets of ``met`` with more than one label.

    ``most`` is the label that most members of the bucket have.
    """
    centers = met.select("bucket", F.col("center").alias("node")).distinct()
    members = met.select("bucket", F.col("member").alias("node")).unionByName(centers)
    members = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = members.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "label"))["label"].alias("most"), F.count(F.lit(1)).alias("n"), F.sum("n").alias("members")
    )
    sizes = checkpointed(sizes.where("n > 1"))
    return spread_join(members, sizes.select("bucket", "most"), "bucket", heavy_keys(sizes, "bucket", "members"), ["node"])


def near_links(
    docs: DataFrame, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``nodes(node, id)``, one row a document with text, ``links(a, b, similarity)`` and
    ``labels(node, label)`` of the texts with links.

    ``node`` is the digest of a text, so copies share it; links are between different texts.
    """
    own = docs.where(F.col(text).isNotNull()).select(
        _node(F.col(text)).alias("node"), F.col(key).alias("id"), F.col(text).alias("text")
    )
    schema = own.select("node", "id").schema.add("sketch", T.ArrayType(T.IntegerType()))
    sketched = checkpointed(own.mapInArrow(_sketch_batches, schema))
    # One copy speaks for a text: that of the least id.
    nodes = checkpointed(sketched.groupBy("node").agg(F.min("id").alias("id"), F.any_value("sketch").alias("sketch")))
    sketch = nodes.select("node", "sketch")
    spots = range(0, ENTRIES, BAND)
    bands = F.array(*[F.xxhash64(F.lit(e), *[F.col("sketch")[e + k] for k in range(BAND)]) for e in spots])
    members = sketch.where(F.exists("sketch", lambda x: x != 0)).select("node", F.explode(bands).alias("bucket"))
    met = _met(members, sketch)
    # Blocks only meet texts that share a bucket, so all texts that are read again are brought here,
    # once.  The table is made of the few wanted digests, so no text is sorted.
    needed = met.select(F.explode(F.array("center", "member")).alias("_node")).distinct()
    needed = nodes.select(F.col("node").alias("_node"), F.col("id").alias("_id")).join(needed, "_node")
    # Identical rows of one id may all stay; they only repeat a comparison.
    same = (own["node"] == needed["_node"]) & own["id"].eqNullSafe(needed["_id"])
    texts = checkpointed(own.join(needed.hint("shuffle_hash"), same).select("node", "text"))
    compared = _compare(met.where("near").select("center", "member").distinct(), texts)
    links = checkpointed(compared.where("similarity > 0").select(F.col("center").alias("a"), F.col("member").alias("b"), "similarity"))
    # So far a text met the centers of its buckets; now it meets all members of other classes.
    labels = components(links)
    mixed = checkpointed(_mixed(met, labels))
    if mixed.limit(1).count():
        # Identical rows of one id are one here.
        members = mixed.join(sketch, "node").join(texts.dropDuplicates(["node"]), "node")
        own_class = F.col("label") == F.col("most")
        more = checkpointed(meet_in_blocks(members, "a binary, b binary, similarity double", _strangers, own_class))
        if more.limit(1).count():
            links = links.unionByName(more)
            labels = extended(labels, more)
    return sketched.select("node", "id"), links, labels


def _classed(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``node, id, label, n_links`` of each row with a text, and the counts of rows by digest."""
    rows, links, labels = near_links(docs, key, text)
    both = links.select("a", "b").union(links.select("b", "a")).distinct()
    degree = both.groupBy(F.col("a").alias("node")).agg(F.count(F.lit(1)).alias("n_links"))
    copies = rows.groupBy("node").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
    known = copies.join(labels, "node", "left").join(degree, "node", "left")
    known = known.select("node", "least", "copies", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return rows, checkpointed(known)


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, class_id, n_links`` for each row; ``class_id`` is the least key of the class.

    A class is all documents reached over exact copies and over links.  Two texts are linked if
    their words align with edits of at most 0.2 of the longer text and their sketches propose the
    pair.  Texts whose five-word shingles resemble each other by 0.8 or more (shared over all) are
    proposed but for 3 in a million; of pairs with scattered edits that change more shingles,
    RECALL_BY_EDITS gives the share that is found.  ``n_links`` counts links of the row's text to
    different texts that were compared and held.  Equal texts, the empty text too, share a class;
    texts of under five words only match exact copies.  A row with a null text is a class of its
    own, and a row with a null key gets the class of its text, or null if no row of it has a key.
    Repeated rows stay, one result row each.
    """
    rows, known = _classed(docs, key, text)
    sizes = known.groupBy("label").agg(F.min("least").alias("class_id"), F.count(F.lit(1)).alias("_n"))
    ids = spread_join(known, sizes.select("label", "class_id"), "label", heavy_keys(sizes, "label", "_n"), ["node"])
    heavy = heavy_keys(known, "node", "copies")
    found = spread_join(rows, ids.select("node", "class_id", "n_links"), "node", heavy, ["id"])
    silent = docs.where(F.col(text).isNull()).select(
        F.col(key), F.col(key).alias("class_id"), F.lit(0).cast("long").alias("n_links")
    )
    return found.select(F.col("id").alias(key), "class_id", "n_links").unionByName(silent)


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class: that of the least key; all columns pass through.

    Of texts of one class under the least key the one of least digest stays, so different texts
    under one key that are no near duplicates both stay.  Rows with a null key or a null text stay.
    Of rows repeated with key and text one stays.
    """
    rows, known = _classed(docs, key, text)
    own = F.struct(F.col("least").alias("id"), F.col("node"))
    sizes = known.where("least is not null").groupBy("label").agg(F.min(own).alias("stays"), F.count(F.lit(1)).alias("_n"))
    heirs = spread_join(known, sizes.select("label", "stays"), "label", heavy_keys(sizes, "label", "_n"), ["node"])
    heirs = heirs.select("node", F.col("stays.id").alias("_id"), F.col("stays.node").alias("_node"))
    placed = spread_join(rows.where("id is not null"), heirs, "node", heavy_keys(known, "node", "copies"), ["id"])
    stays = (F.col("id") == F.col("_id")) & (F.col("node") == F.col("_node"))
    placed = checkpointed(placed.select("id", "node", stays.alias("stays")))
    go = placed.where("not stays").select("id", "node").distinct()
    digest = "__tierwise_node"
    kept = docs.withColumn(digest, _node(F.col(text)))
    # The table is made of keys and digests; texts are only passed by it.
    go = go.select(F.col("id").alias("_id"), F.col("node").alias("_node")).hint("shuffle_hash")
    kept = kept.join(go, (kept[key] == go["_id"]) & (kept[digest] == go["_node"]), "left_anti")
    twice = placed.where("stays").groupBy("id", "node").count().where("count > 1")
    if twice.limit(1).count():
        apart = F.col(key).isNull() | F.col(text).isNull()
        kept = kept.where(~apart).dropDuplicates([key, digest]).unionByName(kept.where(apart))
    return kept.drop(digest)

"""Documents that hold a benchmark item, found by SimHash over item-sized windows.

Words are lower-case runs of letters and digits.  A window is as long as the item and its weight
is that of its five-word shingles, each counted as often as it occurs.  Only windows that begin
with a shingle of the item need a look: moving any other window to its first common shingle keeps
all common ones.  A window's 64-bit SimHash is compared with the item's by its blocks: there is
one block more than the radius, so fingerprints within the radius agree in a whole block.  What
is within the radius is verified by the exact weighted Jaccard similarity of the shingles.
Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.llm.frames import broadcast_if_small, settled

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: At a similarity of 0.8 about 10 of 64 bits differ, with a deviation of 2.9; beyond 22 lies one
#: pair in a hundred thousand.
BITS, RADIUS = 64, 22
#: Shingles of all items are broadcast up to here (16 bytes each), else the join is by shuffle.
BROADCAST_SHINGLES = 2_000_000


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _with_shingles(df: DataFrame, text: str) -> DataFrame:
    """Adds ``_n`` words and the hashes ``_shingles``; no shingle where there are under five words."""
    df = settled(df, _words=F.transform(_words(F.col(text)), lambda w: F.xxhash64(w)))
    one = lambda i: F.xxhash64(*[F.get("_words", i + k) for k in range(SHINGLE_WORDS)])
    places = F.when(F.size("_words") >= SHINGLE_WORDS, F.sequence(F.lit(0), F.size("_words") - SHINGLE_WORDS))
    shingles = F.transform(F.coalesce(places, F.array().cast("array<int>")), one)
    return settled(df, _shingles=shingles, _n=F.size("_words")).drop("_words")


def _simhash(shingles: str) -> Column:
    """Bit b is set where more of the shingles, as often as they occur, have it than not."""
    vote = lambda b: F.aggregate(
        shingles, F.lit(0), lambda total, h: total + F.getbit(h, b) * 2 - 1
    )
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        F.lit(0).cast("long"),
        lambda found, b: found.bitwiseOR(F.when(vote(b) >= 0, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(0)),
    )


def _blocks(fingerprint: str) -> Column:
    """Number and value of each of RADIUS + 1 blocks of near equal width."""
    edges = [i * BITS // (RADIUS + 1) for i in range(RADIUS + 2)]
    return F.array(
        *[
            F.shiftrightunsigned(fingerprint, low).bitwiseAND(F.lit((1 << (high - low)) - 1)) + F.lit(i << 32)
            for i, (low, high) in enumerate(zip(edges, edges[1:]))
        ]
    )


def _counted(df: DataFrame, shingles: str, out: str) -> DataFrame:
    """Adds hashes of (shingle, how often it came before), so that a set has every occurrence."""
    df = settled(df, _sorted=F.array_sort(shingles))
    place = lambda x, i: F.xxhash64(x, i - F.array_position("_sorted", x).cast("int"))
    return settled(df, **{out: F.transform("_sorted", place)}).drop("_sorted")


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    least: float = SIMILARITY,
) -> DataFrame:
    """``key, item, start, n_words, similarity``: the best window of each document for each item.

    Pairs with a similarity of ``least`` or more; of equally similar windows the first.  ``start``
    counts words from 0 and ``n_words`` is the item's length; a document shorter than the item is
    one window.  Items and documents of under five words, null texts and null items have no
    result.  Repeated rows give one result row; a null key is a key like others.
    """
    named = items.select(F.col(item).alias("_item"), F.col(item_text).alias("_t")).where("_item is not null")
    named = _with_shingles(named, "_t").drop("_t").where(F.size("_shingles") > 0).distinct()
    named = settled(_counted(named, "_shingles", "_item_set"), _item_print=_simhash("_shingles"))
    named = named.withColumnsRenamed({"_n": "_item_n", "_shingles": "_item_shingles"})
    pairs = named.select("_item", "_item_n", F.size("_item_set").alias("_m"), F.explode(F.array_distinct("_item_shingles")).alias("_s"))
    size = pairs.count()
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).withColumn("_row", F.xxhash64("_key", "_text"))
    places = _with_shingles(rows, "_text").select("_key", "_row", "_n", F.posexplode("_shingles").alias("_at", "_s"))
    # A shingle of an item begins each window of interest; near the end the last window holds it.
    seeds = places.join(broadcast_if_small(pairs, size, BROADCAST_SHINGLES), "_s").select(
        "_key", "_row", "_item", "_m", "_at", F.least("_at", F.greatest(F.col("_n") - F.col("_item_n"), F.lit(0))).alias("_start")
    )
    # As similar as asked needs that share of the item's shingles somewhere in the document.
    windows = (
        seeds.groupBy("_key", "_row", "_item", "_m")
        .agg(F.count_distinct("_at").alias("_common"), F.collect_set("_start").alias("_starts"))
        .where(F.col("_common") >= F.col("_m") * least)
    )
    per_row = windows.groupBy("_key", "_row").agg(F.collect_list(F.struct("_item", "_starts")).alias("_wanted"))
    held = rows.select(F.col("_row").alias("_r"), "_text").join(per_row, F.col("_r") == F.col("_row")).drop("_r")
    held = _with_shingles(held, "_text").select("_key", "_shingles", F.explode("_wanted").alias("_w"))
    held = held.select("_key", "_shingles", "_w._item", F.explode("_w._starts").alias("_start"))
    held = held.join(broadcast_if_small(named, size, BROADCAST_SHINGLES), "_item")
    width = F.greatest(F.col("_item_n") - SHINGLE_WORDS + 1, F.lit(1))
    held = settled(held, _window=F.slice("_shingles", F.col("_start") + 1, width)).drop("_shingles", "_item_shingles")
    held = settled(held, _print=_simhash("_window"))
    held = held.where(F.arrays_overlap(_blocks("_print"), _blocks("_item_print"))).where(
        F.bit_count(F.col("_print").bitwiseXOR(F.col("_item_print"))) <= RADIUS
    )
    held = _counted(held, "_window", "_window_set")
    held = settled(held, _common=F.size(F.array_intersect("_window_set", "_item_set")))
    held = held.withColumn("_like", F.col("_common") / (F.size("_window_set") + F.size("_item_set") - F.col("_common")))
    best = F.max(F.struct("_like", (-F.col("_start")).alias("_at"))).alias("_best")
    found = held.where(F.col("_like") >= least).groupBy("_key", "_item", "_item_n").agg(best)
    return found.select(
        F.col("_key").alias(key),
        F.col("_item").alias(item),
        (-F.col("_best._at")).cast("long").alias("start"),
        F.col("_item_n").cast("long").alias("n_words"),
        F.col("_best._like").alias("similarity"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents that hold an item; rows with a null key stay."""
    gone = contaminated(docs, items, key, text).select(key).distinct()
    return docs.join(gone, key, "left_anti")

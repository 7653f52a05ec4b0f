"""Registered text queries against their SQL or plain Python, and the edge cases of each operator."""

import base64
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from compare import compare
from pyspark.sql import functions as F

import corpus_pipeline
from tierwise.llm import (
    blocks,
    catalog,
    chat,
    components,
    decontamination,
    fingerprints,
    language_id,
    masked_lm,
    mixing,
    near_dedup,
    skew,
    substrings,
    url_filters,
    warc,
)
from tierwise.llm.words import words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bucket string, count long"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", 0, "x", 1) for k, t in rows], DOCS)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))


EDGE = [(None, "a b"), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, prose(1, 40)), (5, prose(1, 40)), (6, prose(2, 5000))]


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in catalog.QUERIES.items() if sql))
def test_query_equals_sql(spark, sf, name):
    run, sql = catalog.QUERIES[name]
    assert compare(run(spark, sf), sql, sf) is None


def test_words_are_runs_between_ascii_spaces():
    text = ["", "a  b c\td\x0be ", None, "  x", "é ü \x0c"]
    words = words_of(pa.array(text))
    want = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in text]
    assert words.counts.tolist() == [len(w) for w in want]
    flat = [x for w in want for x in w]
    assert len(set(words.hashes.tolist())) == len(set(flat))


def test_windows_are_equal_only_for_equal_words():
    words = words_of(pa.array(["p q r s p q r", "q r"]))
    two, whole = words.windows(2), words.whole(2)
    assert whole.tolist() == [True] * 6 + [False, True, False]
    assert two[0] == two[4] and two[1] == two[5] == two[7] and two[0] != two[1]


def test_fingerprint_follows_the_walk():
    text = prose(3, 60)
    kinds = [(ord(c) ^ (ord(c) >> 7)) & 127 for c in text]
    seen, step = [], 0
    for kind in kinds:  # one step at a time over the shared bits
        stay = int(fingerprints._DWELL[kind * fingerprints.PERIOD + step % fingerprints.PERIOD])
        seen += [kind] * stay
        step += stay
    mine = fingerprints.fingerprint_texts(["x" * 9, text])[1]
    steps, parts = fingerprints._unpack(mine)
    assert steps == step
    for octave, bits in parts.items():
        for at, bit in zip(fingerprints._samples(octave).tolist(), bits.tolist()):
            want = fingerprints._seen_bit(np.array([at]), np.array([seen[at]]))[0] if at < step else False
            assert bool(bit) == bool(want)


def test_likeness_falls_with_edits():
    a, b = prose(4, 600), prose(5, 600)
    changed = a[: len(a) * 3 // 4] + b[: len(a) // 4]
    p = fingerprints.fingerprint_texts([a, changed, b, "", a])
    assert p[0] == p[4] and fingerprints.likeness(p[0], p[4]) == 1.0
    assert 0.6 < fingerprints.likeness(p[0], p[1]) < 0.9 and fingerprints.likeness(p[0], p[2]) < 0.25
    assert fingerprints.likeness(p[3], p[3]) == 1.0 and fingerprints.likeness(p[0], p[3]) == 0.0


@pytest.mark.parametrize("rows", [EDGE[1:5] + EDGE[6:], [(7, "only one")], []])
def test_edited_fingerprints(spark, rows):
    got = sorted(map(tuple, fingerprints.edited_fingerprints(frame(spark, rows)).collect()))
    rows = sorted((k, t or "") for k, t in rows)
    texts = [t for _, t in rows]
    want = []
    for i, (k, t) in enumerate(rows):
        after, n = texts[(i + 1) % len(texts)], len(t) // 4
        edited = t[: len(t) - n] + after[:n]
        p, q, r = fingerprints.fingerprint_texts([t, edited, after])
        want.append((k, len(t), edited, p, q, fingerprints.likeness(p, q), fingerprints.likeness(p, r)))
    assert got == sorted(want)


def test_alike_pairs(spark):
    a = prose(6, 300)
    rows = [(1, a), (2, a + " zz"), (3, prose(7, 300)), (4, ""), (5, a), (None, a)]
    pairs = fingerprints.alike_pairs(fingerprints.fingerprints(frame(spark, rows))).collect()
    assert [(r["a"], r["b"]) for r in pairs] == [(1, 2)]


def test_alike_pairs_equal_brute_force(spark):
    r = random.Random(8)
    texts = ["".join(r.choice("ab") for _ in range(r.randint(1, 16))) for _ in range(400)]
    texts += [prose(50 + i // 2, 60) + " zz" * (i % 2) for i in range(40)]
    prints = fingerprints.fingerprint_texts(texts)
    first = {p: i for i, p in reversed([*enumerate(prints)])}
    bands = {p: set(fingerprints.band_keys(p, 21)) for p in first}
    want = {
        (i, k): fingerprints.likeness(p, q)
        for p, i in first.items()
        for q, k in first.items()
        if i < k and bands[p] & bands[q] and fingerprints.likeness(p, q) >= 0.8
    }
    docs = fingerprints.fingerprints(frame(spark, [*enumerate(texts)]))
    got = {(row["a"], row["b"]): row["likeness"] for row in fingerprints.alike_pairs(docs).collect()}
    assert got == want
    few = {i for i, p in enumerate(prints) if fingerprints._unpack(p)[0] < fingerprints.BAND_BITS}
    assert any(i in few for i, _ in want) and any(i >= 400 for i, _ in want)
    members = {row["doc_id"]: row["id"] for row in fingerprints.equal_fingerprints(docs).collect()}
    assert members == {i: first[p] for i, p in enumerate(prints)} and len(set(members.values())) < len(texts)


def test_mix_stays_within_a_block(spark):
    weights = {"a": 5, "b": 2, None: 3, "d": 1.0}
    rows = [(i, "abd"[i % 3] if i % 7 else None) for i in range(400)] + [(0, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    got = sorted(mixing.mix_sources(docs, weights, block_rows=2).collect(), key=lambda r: r["position"])
    assert sorted((r["doc_id"], str(r["source"])) for r in got) == sorted((k, str(s)) for k, s in rows)
    blocks = sorted({(r["slot"], r["source"] or "") for r in got})
    assert [b[0] for b in blocks] == list(range(len(blocks)))
    names = {s or "": w for s, w in weights.items()}
    total = sum(names.values())
    left = {s: sum(b[1] == s for b in blocks) for s in names}
    until = min(n / names[s] * total for s, n in left.items())
    taken = dict.fromkeys(names, 0)
    for t, (_, s) in enumerate(blocks, 1):
        taken[s] += 1
        if t < until - total:
            assert all(abs(taken[x] - t * w / total) < 1 for x, w in names.items())


def test_mix_of_nothing(spark):
    assert mixing.mix_sources(spark.createDataFrame([], "doc_id long, source string"), {"a": 1}).count() == 0
    assert sum(mixing.quotas({"a": 0.5, "b": 0.25, "c": 0.2501}).values()) == mixing.RESOLUTION


def test_mix_of_any_weights(spark, monkeypatch):
    monkeypatch.setattr(mixing, "STRETCH", 3)  # stretches are put aside
    test_mix_stays_within_a_block(spark)
    assert mixing.quotas({"a": 12_000, "b": 6}) == {"a": 2000, "b": 1}
    assert mixing.quotas({"a": 1_000_000, "b": 1}) == {"a": 999, "b": 1}
    rows = [(None if i % 4 == 0 else i, "ab"[i % 2], "x", "y", 7) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, block string, slot string, _rank int")
    got = mixing.mix_sources(docs, {"a": 1_000_000, "b": 1}).collect()
    assert sorted(r["position"] for r in got) == list(range(40)) and sum(r["doc_id"] is None for r in got) == 10


def words(text):
    return re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", (text or "").lower()).split()


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
        row = new
    return row[-1]


def test_alignment_never_beats_edit_distance():
    r = random.Random(8)
    for n in (6, 40, 120):
        a = prose(n, n).split()
        for edits in (0, 1, n // 12, n // 6, n):
            b = list(a)
            for _ in range(edits):
                i = r.randrange(len(b))
                b[i : i + 1] = r.choice([[], ["zz"], [b[i], "yy"]])
                b = b or ["q"]
            x, y = (words_of(pa.array([" ".join(w)])) for w in (a, b))
            got = near_dedup.aligned_similarity(x.hashes, near_dedup._labelled(x)[0], y.hashes, near_dedup._labelled(y)[0])
            true = 1 - distance(a, b) / max(len(a), len(b))
            assert got <= true + 1e-9
            if edits <= n // 12 and n > 20:
                assert got == pytest.approx(true, abs=4 / n)
            assert near_dedup.edit_distance(x.hashes, y.hashes, 10**6) == distance(a, b)


def test_near_duplicate_classes(spark):
    a, b = prose(9, 120), prose(10, 120)
    near = a.split()
    near[60] = "Changed,"
    rows = [*EDGE, (10, a), (11, a), (12, " ".join(near)), (13, b), (14, a[:200] + b[200:]), (15, ""), (16, "one")]
    docs = frame(spark, rows)
    got = {(r["doc_id"], r["class_id"]) for r in near_dedup.near_duplicate_classes(docs).collect()}
    assert got == {(None, None), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (10, 10), (11, 10), (12, 10), (13, 13), (14, 14), (15, 2), (16, 4)}
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, (None, 1, 2, 3, 4, 5, 6, 10, 13, 14)))
    assert near_dedup.near_duplicate_classes(frame(spark, [])).count() == 0


def test_near_duplicates_equal_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: r["class_id"] for r in catalog.op3_near_duplicates(spark, sf).collect()}
    texts = {r["doc_id"]: words(r["text"]) for r in docs.collect()}
    shingles = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, w in texts.items()}
    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(shingles[a] & shingles[b])
            if both and both >= 0.8 * len(shingles[a] | shingles[b]):
                assert got[a] == got[b]
            if got[a] == got[b] == a:
                assert distance(texts[a], texts[b]) <= 0.3 * max(len(texts[a]), len(texts[b]))


def test_near_duplicates_of_members_that_are_no_centers(spark):
    def replaced(w, at, n, seed):
        return [*w[:at], *prose(seed, n).split(), *w[at + n :]]

    base = prose(40, 200).split()
    family = [replaced(base, i % 140, 4, 100 + i) for i in range(150)]
    bridge = replaced(family[23], 160, 38, 41)  # 0.81 like family[23], less like the others
    other = replaced(bridge, 110, 38, 42)  # 0.81 like the bridge
    texts = [*map(" ".join, [*family, bridge, other]), prose(43, 200)]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicate_classes(frame(spark, [*enumerate(texts)])).collect()}
    assert got == {**dict.fromkeys(range(152), 0), 152: 152}


def test_all_members_meet_in_blocks(spark):
    rows = [(b, n, n % 5 < c) for b, size, c in [(1, 1, 0), (2, 9, 0), (3, 40, 4), (4, 6, 5), (5, 30, 1)] for n in range(size)]

    def meet(table, meetings):
        bucket, node = table.column("bucket").to_pylist(), table.column("node").to_pylist()
        pairs = [(bucket[i], *sorted((node[i], node[k]))) for i, others in meetings for k in others.tolist()]
        columns = list(zip(*pairs)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["bucket", "a", "b"])

    members = spark.createDataFrame(rows, "bucket long, node long, joined boolean")
    found = blocks.meet_in_blocks(members, "bucket long, a long, b long", meet, F.col("joined"), block=4)
    want = [(b, m, n) for b, m, x in rows for c, n, y in rows if b == c and m < n and not (x and y)]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 40), (40, 45), (None, 3), (9, 9)], "a long, b long")
    got = {r["node"]: r["label"] for r in components.components(links).collect()}
    assert got == {**dict.fromkeys(range(21), 0), 40: 40, 45: 40, 50: 40}


def test_settled_links_are_joined_once(spark, monkeypatch):
    """A link inside a class is not joined in later rounds, and more links do not join it again."""
    rng = np.random.default_rng(2)
    rows = [(int(a), int(b)) for a, b in rng.integers(0, 60, (600, 2)) if a != b]
    rows += [(1000 + i, 1001 + i) for i in range(30)]
    links = spark.createDataFrame(rows, "a long, b long")
    joined, plain = [], components.spread_join

    def counted(left, *rest):
        joined.append(left.count())
        return plain(left, *rest)

    monkeypatch.setattr(components, "spread_join", counted)
    labels = components.components(links)
    nodes = {n: 0 for n in range(60)} | {1000 + i: 1000 for i in range(31)}
    assert dict(labels.collect()) == nodes
    different = len({tuple(sorted(r)) for r in rows})
    assert sum(joined) <= 2 * different + 6 * len(nodes)
    joined.clear()
    more = spark.createDataFrame([(1030, 7), (2000, 2001), (2001, 5000), (5, None), (8, 8)], "a long, b long")
    got = dict(components.extended(labels, more).collect())
    assert got == {n: 0 for n in nodes} | {n: 2000 for n in (2000, 2001, 5000)}
    assert max(joined) <= len(nodes) + 3


def test_components_equal_a_walk(spark, few_together):
    rng = np.random.default_rng(3)
    for size, n in ((200, 60), (200, 150), (120, 400)):
        rows = [tuple(map(int, r)) for r in rng.integers(0, size, (n, 2))]
        label = list(range(size))
        for _ in range(size):
            for a, b in rows:
                label[a] = label[b] = min(label[a], label[b])
        want = {x: label[x] for a, b in rows if a != b for x in (a, b)}
        assert dict(components.components(spark.createDataFrame(rows, "a long, b long")).collect()) == want
        cut = n // 2
        known = components.components(spark.createDataFrame(rows[:cut], "a long, b long"))
        assert dict(components.extended(known, spark.createDataFrame(rows[cut:], "a long, b long")).collect()) == want


@pytest.mark.parametrize("scale", [1, 60])
def test_places_in_one_lookup_equal_each_alone(scale):
    """Scores of any size, and a step on them, equal those of one place after another in double precision."""
    rng = np.random.default_rng(6)
    weights = {k: (scale * (v + rng.normal(0, 0.2, v.shape))).astype(np.float32) for k, v in masked_lm.initial(5).items()}
    assert masked_lm._sides(weights)[2] == (scale == 1)
    own = words_of(pa.array(["", "a", prose(12, 40), None, "b c", prose(13, 30)]))
    inputs, upper, lower = masked_lm._buckets(own)
    padded, stands = masked_lm._padded(own, inputs)
    around = padded.take(stands + masked_lm._STEPS)
    text, half = own.text_of(), masked_lm.HALF
    slopes, want = np.zeros((2, half)), []
    for i in range(len(inputs)):
        h = np.zeros(masked_lm.WIDTH)
        for k, o in enumerate(masked_lm.OFFSETS):
            inside = 0 <= i + o < len(inputs) and text[i + o] == text[i]
            assert around[k, i] == (inputs[i + o] if inside else masked_lm.BUCKETS)
            h += weights["embed"][around[k, i]].astype(float) * weights["place"][k]
        h = np.tanh(h)
        each = [h @ weights["upper"] + weights["upper_bias"], h @ weights["lower"] + weights["lower_bias"][upper[i]]]
        logs = [x - x.max() - np.log(np.exp(x - x.max()).sum()) for x in each]
        want.append(logs[0][upper[i]] + logs[1][lower[i]])
        for k, true in enumerate((upper[i], lower[i])):
            slopes[k] += (np.exp(logs[k]) - (np.arange(half) == true)) / len(inputs)
    np.testing.assert_allclose(masked_lm.place_scores(weights, own, np.arange(len(inputs))), want, rtol=1e-3, atol=1e-3 * scale)
    moved = {k: v.copy() for k, v in weights.items()}
    masked_lm._step(moved, {k: np.zeros_like(v) for k, v in weights.items()}, around, upper, lower, 0.5)
    np.testing.assert_allclose(moved["upper_bias"] - weights["upper_bias"], -0.5 * slopes[0] / np.sqrt(slopes[0] ** 2 + 1e-6), atol=2e-2)


def test_pseudo_likelihood_equals_loops(spark):
    weights = masked_lm.initial(3)
    rng = np.random.default_rng(0)
    weights = {k: v + rng.normal(0, 0.2, v.shape).astype(np.float32) for k, v in weights.items()}
    texts = ["", "a", "a b", prose(11, 9)]
    got = masked_lm.score(frame(spark, [*enumerate(texts), (9, None)]), weights).orderBy("doc_id").collect()
    for row, text in zip(got, [*texts, ""]):
        own = words_of(pa.array([text]))
        inputs, upper, lower = masked_lm._buckets(own)
        total = 0.0
        for i in range(len(inputs)):
            h = np.zeros(masked_lm.WIDTH)
            for o, offset in enumerate(masked_lm.OFFSETS):
                at = inputs[i + offset] if 0 <= i + offset < len(inputs) else masked_lm.BUCKETS
                h += weights["embed"][at].astype(float) * weights["place"][o]
            h = np.tanh(h)
            for side, bias, pick in (("upper", weights["upper_bias"], upper[i]), ("lower", weights["lower_bias"][upper[i]], lower[i])):
                x = h @ weights[side] + bias
                total += x[pick] - math.log(np.exp(x).sum())
        assert row["n_tokens"] == len(inputs) and row["log_prob"] == pytest.approx(total, abs=1e-3)
        assert (row["mean_log_prob"] is None) == (not len(inputs))


def test_training_beats_frequencies(spark):
    """At the registered settings, on held-out rows, against frequencies of the same buckets."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    seen, rest = docs.where("doc_id % 4 > 0"), docs.where("doc_id % 4 = 0")
    mean = lambda w: masked_lm.score(rest, w).agg(F.sum("log_prob") / F.sum("n_tokens")).first()[0]
    counts = masked_lm.word_counts(seen)
    frequencies = masked_lm.initial(held=masked_lm.bucket_words(counts))
    trained = masked_lm.fit(seen, counts=counts)
    assert mean(trained) > mean(frequencies) + 0.03 > mean(masked_lm.initial()) + 0.3
    again = masked_lm.fit(seen, counts=counts)
    assert all((again[k] == v).all() for k, v in trained.items())


def test_training_on_nothing(spark):
    empty = masked_lm.fit(frame(spark, [(1, None), (2, "")]))
    assert all((empty[k] == v).all() for k, v in masked_lm.initial(held=np.zeros(masked_lm.HALF**2)).items())
    nothing = frame(spark, [])
    assert masked_lm.score_words(nothing, empty, masked_lm.word_counts(nothing)).count() == 0
    odd = spark.createDataFrame([("a", "x y", 1, 2), ("a", "x y", 1, 2), (None, None, 3, 4), ("b", prose(8, 40_000), 5, 6)], "word string, text string, times int, n int")
    got = masked_lm.score_words(odd, empty, masked_lm.word_counts(odd), key="word").collect()
    assert sorted((r["word"] or "", r["n_tokens"]) for r in got) == [("", 0), ("a", 2), ("a", 2), ("b", 40_000)]


def test_every_word_is_a_target_once():
    table = pa.table({"text": [prose(i, 50 + i) for i in range(20)]})
    for rounds in (1, masked_lm.ROUNDS, 3, 8):
        flat, targets = masked_lm._flat(masked_lm.initial()), 0.0
        for turn in range(rounds):
            run = masked_lm._train("text", flat, turn, rounds, 0)
            targets += sum(b.column("words")[0].as_py() for b in run(iter(table.to_batches())))
        assert targets == sum(50 + i for i in range(20))


@pytest.mark.parametrize("few", [0, masked_lm.FEW_WORDS])
def test_words_are_scored_inside_their_bucket(spark, few, monkeypatch):
    monkeypatch.setattr(masked_lm, "FEW_WORDS", few)
    weights, texts = masked_lm.initial(4), ["", "a", "a b a", prose(11, 9), prose(11, 9)]
    counts = masked_lm.word_counts(frame(spark, [*enumerate(texts[:4]), (9, None)]))
    docs = frame(spark, [*enumerate([*texts, "never seen"]), (9, None), (9, "a")])
    rows = lambda df: sorted(map(tuple, df.select("doc_id", "n_tokens", "log_prob").collect()))
    bucket = lambda w: tuple(int(x[0]) for x in masked_lm._buckets(words_of(pa.array([w])))[1:])
    known = [w for t in texts[:4] for w in t.split()]
    split = {i: t.split() for i, t in enumerate([*texts, "never seen"])}
    got, plain = rows(masked_lm.score_words(docs, weights, counts)), rows(masked_lm.score(docs, weights))
    assert len(got) == len(plain) == 8
    for row, of_buckets in zip(got, plain):
        own = split.get(row[0], ["a"] * row[1])
        inside = sum(math.log(max(known.count(w), 1) / (sum(bucket(x) == bucket(w) for x in known) + 1)) for w in own)
        assert row[:2] == of_buckets[:2] and row[2] == pytest.approx(of_buckets[2] + inside, abs=1e-5)


def test_remove_repeated_edges(spark):
    long = prose(12, 30)
    rows = [*EDGE, (7, "x " + long), (8, long + " y"), (8, long), (None, long), (9, prose(13, 12) + " " + long[:5])]
    docs = frame(spark, rows).withColumn("n_words", F.lit("old"))
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_text"]) for r in substrings.remove_repeated(docs).collect())
    first = {}
    split = [(k, re.findall("[^\x20\x09-\x0d]+", t or "")) for k, t in rows]
    big = 1 << 62
    for k, w in split:
        for i in range(len(w) - 12):
            g = tuple(w[i : i + 13])
            first[g] = min(first.get(g, big), big if k is None else k)
    want = []
    for k, w in split:
        gone = {i + j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < (big if k is None else k) for j in range(13)}
        want.append((str(k), len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert got == sorted(want)
    assert substrings.remove_repeated(frame(spark, [])).count() == 0


def test_url_filters(spark):
    day = lambda n: F.timestamp_seconds(F.lit(86400) * n)
    captures = spark.createDataFrame(
        [(1, "http://a.b.com/x", 5), (1, "http://a.b.com/x", 5), (2, "https://u@A.B.com:80", 20), (3, "http://b.com", 500), (4, None, 5), (5, "nohost", 5), (6, "http://z.b.com/", None)],
        "page_id long, url string, d long",
    ).withColumn("fetched_at", day(F.col("d")))
    entries = spark.createDataFrame(
        [("b.com", "domain", "ads", "add", 0), ("b.com", "domain", "ads", "remove", 10), ("b.com", "domain", "ads", "add", 400), ("A.b.com", "host", "spam", "add", 20), ("a.b.com", "host", "x", "add", 20), ("a.b.com", "host", "x", "remove", 20), (None, "host", "q", "add", 0), ("b.com", "other", "q", "add", 0)],
        "pattern string, kind string, category string, action string, d long",
    ).withColumn("dated", day(F.col("d")))
    got = sorted((r["page_id"], r["n_active"], r["categories"], r["blocked"]) for r in url_filters.filter_urls(captures, entries).collect())
    assert got == [(1, 1, "ads", True), (1, 1, "ads", True), (2, 1, "spam", True), (3, 1, "ads", True), (4, 0, "", False), (5, 0, "", False), (6, 0, "", False)]
    assert url_filters.filter_urls(captures, entries.limit(0)).where("blocked").count() == 0


def test_contaminated_edges(spark):
    item = prose(14, 40).split()
    other = prose(15, 30)
    trimmed, broken = item[3:], item[:20] + ["zz"] + item[21:]
    rows = [*EDGE, (20, other + " " + " ".join(item).upper() + ". " + other), (21, " ".join(trimmed)), (22, other + " ".join(broken)), (23, " ".join(item)), (23, " ".join(item))]
    items = spark.createDataFrame([(1, " ".join(item)), (2, "too short"), (3, None), (None, other), (1, " ".join(item))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"], r["start"], r["similarity"]) for r in decontamination.contaminated(frame(spark, rows), items).collect()}
    assert got == {(20, 1, 30, 1.0), (21, 1, 0, 33 / 36), (23, 1, 0, 1.0)}
    kept = decontamination.drop_contaminated(frame(spark, rows), items)
    assert not {20, 21, 23} & {r["doc_id"] for r in kept.collect()} and kept.count() == len(rows) - 4
    assert decontamination.contaminated(frame(spark, []), items).count() == 0
    assert decontamination.contaminated(frame(spark, rows), items.limit(0)).count() == 0


def test_preference_pairs_edges(spark):
    rows = [
        (1, "chosen", 0, "user", "hi<|im_end|>"), (1, "rejected", 0, "user", "hi<|im_end|>"),
        (1, "chosen", 1, "assistant", "yes"), (1, "rejected", 1, "assistant", None),
        (2, "chosen", 0, None, None), (2, "rejected", 0, None, None),
        (3, "chosen", None, "assistant", "é"), (4, "other", 0, "user", "x"), (None, "chosen", 0, "user", "x"),
    ]
    turns = spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string")
    got = {r["pair_id"]: r for r in chat.preference_pairs(turns).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1]["prompt"] == "<|im_start|>user\nhi<\\|im_end|><|im_end|>\n" and got[1]["n_prompt_turns"] == 1
    for side, said in (("chosen", "yes"), ("rejected", "")):
        (span,) = got[1][f"{side}_spans"]
        assert got[1][side][span["start"] : span["end"]] == said + "<|im_end|>\n"
    assert got[2]["chosen"] == got[2]["rejected"] == "" and got[2]["chosen_spans"] == []
    assert got[3]["prompt"] == got[3]["rejected"] == "" and got[3]["chosen"].endswith("é<|im_end|>\n")


def test_forward_sums_all_segmentations():
    model = language_id.LanguageModel(["a", "ab", "b", "▁", "▁a"], ["x"], np.array([[0.2], [0.1], [0.3], [0.05], [0.15], [0.01]]))
    got = np.exp(model.word_scores(["▁ab", "▁?b"]))[:, 0]
    assert got == pytest.approx([0.15 * 0.3 + 0.05 * 0.1 + 0.05 * 0.2 * 0.3, 0.05 * 0.01 * 0.3])


def test_long_words_are_scaled_and_not_cut(monkeypatch):
    r = np.random.default_rng(0)
    pieces = ["a", "ab", "abc", "b", "ba", "c", "ca", "▁", "▁a"]
    prob = r.random((len(pieces) + 1, 2))
    model = language_id.LanguageModel(pieces, ["x", "y"], prob / prob.sum(axis=0))
    words = ["▁" + "".join(r.choice(list("abc?"), n)) for n in (1, 5, 20, 31, 32)]
    counts = r.random((len(words), 2)) * 5
    whole, pieces_found = model.word_scores(words), model.word_scores(words, counts=counts)
    monkeypatch.setattr(language_id, "SHORT_WORD", 0)
    for stretch in (1, 7, 1 << 15):
        monkeypatch.setattr(language_id, "STRETCH", stretch)
        assert model.word_scores(words) == pytest.approx(whole)
    assert model.word_scores(words, counts=counts) == pytest.approx(pieces_found)
    # Far below the least double: the logarithm grows with the length.
    n = 4000
    one, two = model.word_scores(["▁" + "abc" * n, "▁" + "abc" * (2 * n)])
    assert np.isfinite(two).all() and np.all(two < one) and one == pytest.approx(two / 2, rel=1e-3)


def test_language_is_found_on_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r for r in catalog.op9_language_id(spark, sf).collect()}
    langs = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [k for k, r in rows.items() if r["held_out"]]
    assert held and np.mean([rows[k]["lang_pred"] == langs[k] for k in held]) > 0.95
    model = language_id.fit(docs)
    odd = [(1, None), (2, ""), (3, "123 !?"), (4, "the " * 3000), (None, "der die das und nicht"), (5, "x" * 5000)]
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(frame(spark, odd), model).collect()}
    assert got[1] == got[2] == got[3] == "und" and got[4] == "en" and got[None] == "de" and got[5] in model.languages
    assert language_id.predict(frame(spark, []), model).count() == language_id.keep_identified(frame(spark, []), model).count() == 0
    clash = frame(spark, odd).withColumn("lang_pred", F.lit("x")).withColumn("score", F.lit("y"))
    assert sorted(language_id.keep_identified(clash, model).columns) == sorted(clash.columns)
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.predict(clash, model).collect()} == got
    none = language_id.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in language_id.predict(docs, none).collect()} == {"und"}


def test_archive_round_trip(spark, tmp_path):
    rows = [(1, "http://a", "x"), (2, "http://b", "x"), (3, None, None), (4, "http://d\r\nX: y", ""), (None, "http://e", "x"), (5, "http://f", "é" * 70000), (2, "http://b", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = str(tmp_path / "archive")
    warc.write_archive(pages, folder)
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.read_archive(spark, folder).collect())
    assert got == sorted([("1", 1, "revisit", 2), ("2", 1, "response", None), ("2", 1, "response", None), ("3", 0, "revisit", 4), ("4", 0, "response", None), ("None", 1, "response", None), ("5", 140000, "response", None)])
    assert spark.read.parquet(f"{folder}/payloads").count() == 3
    for row in warc.reconstruct(spark, folder).collect():
        record = bytes(row["record"])
        head, rest = record.split(b"\r\n\r\n", 1)
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        size = int(fields[b"Content-Length"])
        assert rest[size:] == b"\r\n\r\n"
        http, payload = rest[:size].split(b"\r\n\r\n", 1)
        if fields[b"WARC-Type"] == b"response":
            assert int(http.split(b"Content-Length: ")[1]) == len(payload)
            assert hashlib.sha1(payload).digest() == base64.b32decode(fields[b"WARC-Payload-Digest"][5:])
        else:
            assert payload == b""
    small = str(tmp_path / "small")
    warc.write_archive(pages, small, smallest=2)
    assert {r["record_type"] for r in warc.read_archive(spark, small).collect()} == {"response"}


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, sf).cache()
        assert out.columns == docs.columns and 0 < out.count() <= kept.count(), name
        kept = out
    ids = sorted(r[0] for r in kept.select("doc_id").collect())
    mixed = corpus_pipeline.run(spark, sf).collect()
    assert sorted(r["doc_id"] for r in mixed) == ids and sorted(r["position"] for r in mixed) == list(range(len(ids)))
    bad = {r["doc_id"] for r in decontamination.contaminated(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert not bad & set(ids)


def test_pipeline_stages_with_odd_tables(spark, sf, monkeypatch):
    schema = "doc_id long, text string, lang string, source string, n_words string, n_removed int, kept_text string, lang_pred string, id int, node string"
    long = prose(77, 30_000)
    rows = [(None, "the and of the house"), (1, None), (2, ""), (3, long), (3, long), (4, long + " end"), (5, prose(5, 60)), (6, prose(6, 60)), (6, prose(7, 60))]
    rest = ("en", "s", "words", 1, "kept", "guess", 2, "node")
    odd = spark.createDataFrame([(k, t, *rest) for k, t in rows], schema)
    empty = spark.createDataFrame([], schema)
    # The guess of this text does not matter here, only which rows pass.
    monkeypatch.setattr(corpus_pipeline, "fit", lambda docs: language_id.LanguageModel(["a", "▁"], ["en"], np.array([[0.5], [0.3], [0.2]])))
    kept = {"language_id": 7, "near_dedup": 7, "substring_dedup": 9, "decontamination": 9}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, sf)
        assert out.columns == odd.columns and stage(spark, empty, sf).count() == 0, name
        assert out.where("n_words = 'words' and kept_text = 'kept' and node = 'node' and lang_pred = 'guess'").count() == out.count()
        texts = sorted(str(r["text"])[:40] for r in out.collect())
        assert len(texts) == kept[name], (name, texts)
    mixed = corpus_pipeline.STAGES[-1][1]
    assert mixed(spark, odd, sf).count() == len(rows) and mixed(spark, empty, sf).count() == 0


@pytest.fixture
def few_together(monkeypatch):
    monkeypatch.setattr(skew, "HEAVY", 5)


def test_spread_join_equals_join(spark, few_together):
    rows = spark.createDataFrame([(None if i % 7 == 0 else "hot" if i % 2 else f"k{i}", i) for i in range(60)], "k string, v int")
    lookup = spark.createDataFrame([("hot", 1), ("k2", 2), ("gone", 3)], "k string, w int")
    heavy = skew.heavy_keys(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k", "n")
    assert {r["k"] for r in heavy.where("k is not null").collect()} == {"hot"}
    for how in ("inner", "left"):
        have = skew.spread_join(rows, lookup, "k", heavy, ["v"], how)
        assert sorted(map(repr, have.select("k", "v", "w").collect())) == sorted(map(repr, rows.join(lookup, "k", how).collect()))


def test_components_with_hubs(spark, few_together):
    links = [(0, i) for i in range(1, 60)] + [(100 + i, 101 + i) for i in range(40)]
    got = dict(components.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(60)} | {100 + i: 100 for i in range(41)}


def test_near_duplicates_with_hot_classes(spark, few_together):
    # Half of the rows are one class: exact copies of some texts, and variants of one of them.
    words = prose(50, 60).split()
    variants = [" ".join([*words[:i], f"v{i}", *words[i + 1 :]]) for i in range(30)]
    rows = [(i, variants[i % 30]) for i in range(90)] + [(1000 + i, prose(900 + i, 30)) for i in range(40)]
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicate_classes(frame(spark, rows)).collect()}
    assert got == {k: 0 if k < 90 else k for k, _ in rows}
    kept = [r["doc_id"] for r in near_dedup.drop_near_duplicates(frame(spark, rows)).collect()]
    assert sorted(kept) == [0, *range(1000, 1040)]


def test_one_key_on_different_texts(spark):
    a, b, c = prose(1, 50), prose(2, 50), prose(3, 50)
    rows = [(1, a), (1, b), (2, a), (2, c), (3, b + " x"), (4, c), (4, c), (None, a), (5, None), (5, None)]
    kept = near_dedup.drop_near_duplicates(frame(spark, rows))
    have = sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect())
    assert have == sorted([("1", a), ("1", b), ("2", c), ("None", a), ("5", "None"), ("5", "None")])
    assert kept.columns == frame(spark, rows).columns


def edited(words, share, seed):
    r = random.Random(seed)
    out = list(words)
    for i in r.sample(range(len(out)), int(share * len(out))):
        out[i] = f"e{seed}x{i}"
    return out


def test_recall_by_edits(spark):
    """The measured shares that the docstring names, and all links at a shingle similarity of 0.8."""
    rows, pairs = [], {}
    for n, share in enumerate(near_dedup.RECALL_BY_EDITS):
        for k in range(120):
            words = prose(10_000 * n + k, 200).split()
            left, right = 2 * (1000 * n + k), 2 * (1000 * n + k) + 1
            rows += [(left, " ".join(words)), (right, " ".join(edited(words, share, n * 1000 + k)))]
            pairs[left, right] = share
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.near_duplicate_classes(frame(spark, rows)).collect()}
    found = {s: np.mean([got[a] == got[b] for (a, b), x in pairs.items() if x == s]) for s in near_dedup.RECALL_BY_EDITS}
    for share, expected in near_dedup.RECALL_BY_EDITS.items():
        assert abs(found[share] - expected) <= 0.15, found
    shingles = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for k, t in rows for w in [t.split()]}
    alike = [(a, b) for a, b in pairs if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])]
    assert len(alike) >= 100 and all(got[a] == got[b] for a, b in alike)


def test_archive_of_one_hot_payload(spark, tmp_path, few_together):
    pages = spark.createDataFrame([(i, f"http://h/{i}", None if i % 2 else f"<p>{i}") for i in range(80)], "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "a"))
    got = {r["page_id"]: r for r in warc.read_archive(spark, str(tmp_path / "a")).collect()}
    assert len(got) == 80 and all(got[i]["refers_to"] == (79 if i % 2 and i != 79 else None) for i in got)


def test_url_filters_with_clashes_and_hot_domains(spark, few_together, monkeypatch):
    hosts = [None if i % 5 == 0 else f"http://h{i % 9}.example.com/{i}" for i in range(200)]
    captures = spark.createDataFrame([(i, u, 86_400 * (i % 50), "x", "y") for i, u in enumerate(hosts)], "page_id long, url string, s long, _host string, _at string")
    captures = captures.withColumn("fetched_at", F.timestamp_seconds("s")).drop("s")
    entries = spark.createDataFrame(
        [("com", "domain", "a", "add", 86_400 * 10), ("com", "domain", "a", "remove", 86_400 * 30), ("h3.example.com", "host", "b", "add", 0)],
        "pattern string, kind string, category string, action string, s long",
    ).withColumn("dated", F.timestamp_seconds("s"))
    want = {}
    for i, u in enumerate(hosts):
        day, names = i % 50, set()
        if u and 10 <= day < 30:
            names.add("a")
        if u and i % 9 == 3:
            names.add("b")
        want[i] = ",".join(sorted(names))
    for most in (100_000, 0):
        monkeypatch.setattr(url_filters, "BROADCAST_ROWS", most)
        found = url_filters.filter_urls(captures, entries)
        assert set(captures.columns) <= set(found.columns)
        got = {r["page_id"]: r for r in found.collect()}
        assert {i: r["categories"] for i, r in got.items()} == want and all(r["_host"] == "x" and r["_at"] == "y" for r in got.values())

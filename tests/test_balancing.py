import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from tierwise.operators import lsh, neighbors as N, resampling as R


def frame(spark, x, y):
    rows = [(i, int(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "key long, label int, vector array<double>")


def brute(x, k, asked):
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    out = {}
    for i in asked:
        order = sorted((d2[i, j], j) for j in range(len(x)) if j != i)[:k]
        out[i] = [j for _, j in order]
    return out


def answer(df):
    return {r["key"]: [n["key"] for n in r["neighbors"]] for r in df.collect()}


@pytest.fixture(scope="module")
def crowded(spark):
    """Whole-number points, a third of them in one place and a third in a tight cluster."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 60, (900, 3)).astype(float)
    x[:300] = 7.0
    x[300:600] = 30.0 + rng.integers(0, 3, (300, 3))
    y = (np.arange(900) % 8 == 0).astype(int)
    return x, y, frame(spark, x, y)


@pytest.mark.parametrize("block_rows", [4096, 120, 40])
def test_neighbors_equal_brute_force(crowded, block_rows):
    x, _, df = crowded
    got = answer(N.nearest_neighbors(df, "key", "vector", 4, ["label"], block_rows=block_rows))
    assert got == brute(x, 4, range(900))


@pytest.mark.parametrize("groups", [2, 6])
def test_groups_of_blocks_equal_brute_force(spark, monkeypatch, groups):
    """In many dimensions, where no block can be ruled out."""
    monkeypatch.setattr(N, "MIN_GROUPS", groups)
    x = np.random.default_rng(5).normal(size=(500, 24))
    x[50:60] = x[40]
    got = answer(N.nearest_neighbors(frame(spark, x, np.zeros(500)), "key", "vector", 4, block_rows=20))
    assert got == brute(x, 4, range(500))


@pytest.mark.parametrize("block_rows", [64, 128, 2048])
def test_shuffle_grows_with_the_points_not_with_their_square(block_rows):
    """A point travels once to each group, so their number must not grow until they are full."""
    for size in (10_000, 100_000, 600_000):
        rows, n_blocks, in_group = N._layout(size, block_rows, 64)
        assert -(-n_blocks // in_group) <= N.MIN_GROUPS
        assert rows * in_group * 64 * 8 <= N.GROUP_BYTES and rows <= 2048
    assert N._layout(500, block_rows, 64)[0] == block_rows
    # Short vectors fill a group by rows.
    rows, _, in_group = N._layout(50_000_000, block_rows, 2)
    assert rows * in_group <= N.GROUP_ROWS


@pytest.mark.parametrize("odd, sent", [(0.0, "float"), (1e-12, "double"), (1e39, "double")])
def test_copies_of_single_precision_numbers_travel_as_such(spark, monkeypatch, odd, sent):
    """One number that single precision doesn't hold keeps all of them double."""
    x = np.random.default_rng(6).normal(size=(200, 12)).astype(np.float32).astype(float)
    x[7, 3] += odd
    kinds, real = [], N._visit

    def seen(shape, k):
        answer = real(shape, k)

        def run(visitors, hosts):
            assert str(visitors.schema.field("vector").type.value_type) == sent
            assert str(hosts.schema.field("vector").type.value_type) == sent
            return answer(visitors, hosts)

        kinds.append(shape)
        return run

    monkeypatch.setattr(N, "_visit", seen)
    got = answer(N.nearest_neighbors(frame(spark, x, np.zeros(200)), "key", "vector", 3, with_vectors=True, block_rows=20))
    assert kinds and got == brute(x, 3, range(200))


def test_whole_groups_are_not_listed_block_by_block():
    pairs = np.array([[0, 0], [0, 1], [0, 3], [2, 4], [2, 2], [2, 3]])
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    assert N._by_group(pairs, 3, 2, 5).to_pylist() == [
        [{"group": 0, "blocks": []}, {"group": 1, "blocks": [3]}],
        [],
        [{"group": 1, "blocks": []}, {"group": 2, "blocks": []}],
    ]


def test_visits_to_many_blocks_are_named_in_bounded_steps():
    rng = np.random.default_rng(3)
    n, n_blocks, k = 600, 4000, 3
    pivots = np.unique(rng.normal(size=(40, 16)), axis=0)
    x = rng.normal(size=(n, 16))
    cell, reach = N._nearest_pivot(x, pivots)
    # Every block holds points of every cell, so nothing is ruled out.
    spans = np.array([(b, c, 0.0, 9.0) for c in range(len(pivots)) for b in range(c, n_blocks, len(pivots))])
    table = pa.table(
        {
            "key": pa.array(np.arange(n)),
            "vector": pa.array(list(x), pa.list_(pa.float64())),
            "is_query": pa.array(np.ones(n, bool)),
            "cell": pa.array(cell.astype(np.int32)),
            "reach": pa.array(reach),
            "block": pa.array(np.full(n, 7, np.int32)),
        }
    )
    kinds = T.StructType([T.StructField("key", T.LongType()), T.StructField("vector", T.ArrayType(T.DoubleType()))])
    local = N._local(N._Shape(kinds, [], False), k, pivots, spans, 500)
    tracemalloc.start()
    visits = local(table).column("visit").to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    gaps = np.sqrt(((x[:, None] - pivots) ** 2).sum(2))
    far = np.sqrt(N._nearest(x, x, np.arange(n), k)[2].reshape(n, k)[:, -1])
    apart = np.sqrt(((pivots[:, None] - pivots) ** 2).sum(2))[gaps.argmin(1)]
    with np.errstate(invalid="ignore"):
        beyond = (gaps**2 - gaps.min(1)[:, None] ** 2) / (2 * apart) > far[:, None] + 1e-6
    meets = (gaps - far[:, None] <= 9.0) & ~beyond
    for i in range(n):
        wanted = [b for b in range(n_blocks) if b != 7 and meets[i, b % len(pivots)]]
        named = [b for v in visits[i] for b in v["blocks"] or range(500 * v["group"], 500 * v["group"] + 500)]
        assert named == wanted
    assert peak < 100 << 20


@pytest.mark.parametrize("scale, offset", [(1.0, 0.0), (1e-3, 1e3), (1e150, 0.0), (1e200, 0.0)])
def test_nearest_pivots_by_product_equal_those_by_differences(scale, offset):
    rng = np.random.default_rng(4)
    pivots = np.unique(offset + scale * rng.integers(0, 4, (60, 5)), axis=0)
    x = offset + scale * rng.integers(0, 7, (3000, 5)) / 2.0
    with np.errstate(over="ignore"):
        cell, reach = N._nearest_pivot(x, pivots)
        gaps = N._to_pivots_directly(x, pivots)
    assert (cell == gaps.argmin(axis=1)).all()
    assert np.allclose(reach, gaps.min(axis=1), rtol=1e-12, atol=0)


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e20])
def test_single_precision_loses_no_neighbour(scale):
    """Tight clusters far apart, whose distances single precision can't tell."""
    rng = np.random.default_rng(3)
    x = scale * (1000.0 * rng.integers(0, 3, (300, 1)) + rng.normal(size=(300, 5)))
    d2 = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    want = np.sort(d2, axis=1)[:, :4]
    bounds = (None, np.full(300, np.inf), want[:, 3] * (1 + 1e-9))
    for bound in bounds:
        qi, _, got = N._nearest(x, x, np.arange(300), 4, bound)
        assert (qi == np.repeat(np.arange(300), 4)).all()
        assert np.allclose(got.reshape(300, 4), want, rtol=1e-9)


def test_vectors_must_be_whole(spark):
    for rows in ([(1, [1.0]), (2, [1.0, 2.0])], [(1, [1.0]), (2, None)], [(1, [1.0]), (2, [None])]):
        with pytest.raises(ValueError, match="one length"):
            N.nearest_neighbors(spark.createDataFrame(rows, "key long, vector array<double>"), "key", "vector", 1)


@pytest.mark.parametrize("block_rows", [4096, 60])
def test_neighbors_of_some_rows_only(crowded, block_rows):
    x, y, df = crowded
    near = N.nearest_neighbors(df, "key", "vector", 3, [], F.col("label") == 1, True, block_rows)
    assert answer(near) == brute(x, 3, np.flatnonzero(y))
    for r in near.collect():
        for n in r["neighbors"]:
            assert n["vector"] == x[n["key"]].tolist()


def test_fewer_points_than_neighbors(spark):
    df = frame(spark, np.array([[0.0], [1.0], [5.0]]), [0, 0, 1])
    assert answer(N.nearest_neighbors(df, "key", "vector", 10)) == {0: [1, 2], 1: [0, 2], 2: [1, 0]}
    assert answer(N.nearest_neighbors(df, "key", "vector", 10, block_rows=1)) == {0: [1, 2], 1: [0, 2], 2: [1, 0]}
    with pytest.raises(ValueError):
        N.nearest_neighbors(df, "key", "vector", 0)


def test_text_keys_and_no_rows(spark):
    df = spark.createDataFrame([("b", [0.0]), ("a", [1.0]), ("c", [1.0])], "key string, vector array<double>")
    assert answer(N.nearest_neighbors(df, "key", "vector", 1)) == {"b": ["a"], "a": ["c"], "c": ["a"]}
    assert N.nearest_neighbors(df.limit(0), "key", "vector", 1).count() == 0


def test_large_offsets_do_not_disturb_the_order(spark):
    rng = np.random.default_rng(2)
    x = 1e7 + rng.integers(0, 50, (200, 2)).astype(float)
    df = frame(spark, x, np.zeros(200))
    assert answer(N.nearest_neighbors(df, "key", "vector", 3)) == brute(x, 3, range(200))


def test_no_pairs_are_emitted_inside_a_block(crowded):
    _, _, df = crowded
    plan = N.nearest_neighbors(df, "key", "vector", 4, block_rows=120)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_classes_are_equal_after_oversampling_and_old_rows_stay(spark, crowded):
    _, _, df = crowded
    for block_rows in (4096, 150):
        out = R.borderline_smote(df, block_rows=block_rows)
        sizes = {r["label"]: r["count"] for r in out.groupBy("label").count().collect()}
        assert sizes[0] == sizes[1]
        assert out.select("key").distinct().count() == out.count()
        assert df.exceptAll(out.where("not synthetic").drop("synthetic")).isEmpty()
    again = R.borderline_smote(df.repartition(3), block_rows=150)
    assert again.exceptAll(out).isEmpty()


def test_nothing_is_made_without_rows_in_danger(spark):
    x = np.concatenate([np.arange(20.0), 1000 + np.arange(15.0)])[:, None]
    y = np.array([0] * 20 + [1] * 15)
    df = frame(spark, x, y)
    assert R.borderline_smote(df).where("synthetic").isEmpty()
    assert R.borderline_groups(df).where("zone <> 'safe'").isEmpty()
    assert R.borderline_smote(df.where("label = 1")).where("synthetic").isEmpty()


def test_snapped_places_are_whole_numbers(spark, crowded):
    _, _, df = crowded
    made = R.borderline_smote(df, snap=[1]).where("synthetic")
    assert made.where("vector[1] <> rint(vector[1])").isEmpty()
    assert not made.where("vector[0] <> rint(vector[0])").isEmpty()


def test_rare_rows_are_never_cleaned_away(crowded):
    _, y, df = crowded
    rare = df.where("label = 1").select("key")
    for out in (R.allknn_clean(df, 3), R.allknn_clean(df, 3, mode="static"), R.ncr_clean(df), R.tomek_clean(df)):
        assert rare.join(out, "key", "left_anti").isEmpty()
    both = R.tomek_clean(df, "both")
    assert df.count() - both.count() == 2 * R.tomek_links(df).count()


def test_rules_from_mild_to_strict(crowded):
    _, _, df = crowded
    sizes = [R.enn_clean(df, 3, rule).count() for rule in ("all_disagree", "majority_disagree", "any_disagree")]
    assert sizes == sorted(sizes, reverse=True)
    static_all = R.allknn_clean(df, 3, mode="static", wrong_in="all").count()
    assert static_all >= R.allknn_clean(df, 3, mode="static", wrong_in="any").count()
    with pytest.raises(ValueError):
        R.enn_clean(df, 3, "most")


def test_cleaning_is_the_same_in_blocks(crowded):
    _, _, df = crowded
    for clean in (R.enn_clean, R.ncr_clean, R.tomek_clean):
        assert clean(df, block_rows=100).exceptAll(clean(df)).isEmpty()


@pytest.mark.parametrize("spare, stop, asks", [(5, False, 1), (5, True, 1), (0, False, 4)])
def test_allknn_lists_neighbours_once(spark, monkeypatch, spare, stop, asks):
    """Rounds strike those that went before; only rows left with too few neighbours are asked again."""
    rng = np.random.default_rng(11)
    x, y = rng.normal(size=(300, 2)), (rng.random(300) < 0.3).astype(int)
    df = frame(spark, x, y).cache()
    left = df
    for k in range(1, 4):
        left = R.enn_clean(left, k).localCheckpoint()
        if stop and left.where("label = 0").count() < left.where("label = 1").count():
            break
    calls, real = [], R.nearest_neighbors
    monkeypatch.setattr(R, "SPARE", spare)
    monkeypatch.setattr(R, "nearest_neighbors", lambda *a, **b: calls.append(a) or real(*a, **b))
    got = {r["key"] for r in R.allknn_clean(df, 3, stop_when_smaller=stop).collect()}
    assert got == {r["key"] for r in left.collect()} and len(got) < 300
    assert len(calls) <= asks


def test_gate_of_neighbourhood_cleaning(crowded):
    _, _, df = crowded
    assert R.ncr_clean(df, 3, threshold=100.0).count() >= R.ncr_clean(df, 3, threshold=0.5).count()


def test_strategy_names(crowded):
    _, _, df = crowded
    assert R.strategy_name("  SMOTE_NCR ") == "borderline_smote_ncr"
    assert R.strategy_name("Borderline-SMOTE") == "borderline_smote"
    assert R.resample(df, "off").count() == 900
    with pytest.raises(ValueError):
        R.resample(df, "adasyn")


def cloud(n, width, seed, copies=0):
    r = np.random.default_rng(seed)
    x = np.round(r.normal(size=(n, width)) + 3 * r.integers(0, 4, (n, 1)), 3)
    x[:copies] = x[0]
    return [(int(k), int(k % 9 == 0), [float(v) for v in row], f"c{k}") for k, row in enumerate(x)]


def brute_lists(rows, k, queries):
    out = {}
    for i, _, x, _ in (r for r in rows if queries(r)):
        d = sorted((sum((a - b) ** 2 for a, b in zip(x, y)), j, c) for j, _, y, c in rows if j != i)
        out[i] = [(round(a, 6), j, c) for a, j, c in d[:k]]
    return out


def lists(df):
    return {r["key"]: [(round(n["d2"], 6), n["key"], n["c"]) for n in r["neighbors"]] for r in df.collect()}


def test_few_queries_are_one_scan(spark):
    rows = cloud(700, 5, 1, copies=230)
    df = spark.createDataFrame(rows, "key long, label int, vector array<double>, c string").repartition(40)
    few = N.nearest_neighbors(df, "key", "vector", 4, ["c"], F.col("label") == 1, with_vectors=True, block_rows=8)
    assert lists(few) == brute_lists(rows, 4, lambda r: r[1] == 1)
    assert all(n["vector"] == rows[n["key"]][2] for r in few.collect() for n in r["neighbors"])
    # The points reach the scan without an exchange; only lists are shuffled.
    plan = few._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("MapInArrow") :]
    assert "Exchange" not in scan[: scan.index("Scan ExistingRDD")].replace("Exchange RoundRobinPartitioning", "")
    blocks = N.nearest_neighbors(df, "key", "vector", 4, ["c"], F.col("label") == 1, block_rows=8, few_bytes=0)
    assert lists(blocks) == lists(few)
    none = N.nearest_neighbors(df, "key", "vector", 4, ["c"], F.lit(False), block_rows=8)
    assert none.count() == 0


def test_lsh_finds_most_neighbors(spark):
    rows = cloud(3000, 8, 2, copies=1000)
    df = spark.createDataFrame(rows, "key long, label int, vector array<double>, c string")
    hashing = lsh.Hashing(12, 6, 8)
    found = lsh.nearest_neighbors_lsh(df, "key", "vector", 5, ["c"], hashing=hashing)
    got, recall = lists(found), lsh.lsh_recall(df, found, "key", "vector", 5, n=150)
    assert len(got) == 3000
    measured = recall.agg(F.sum("n_found") / F.sum("n_exact")).first()[0]
    assert measured >= 0.9 and recall.count() == 150
    asked = {r["key"] for r in recall.collect()}
    exact = brute_lists(rows, 5, lambda r: r[0] in asked)
    # What is found has its exact distance and the order of the exact join.
    for k in asked:
        assert got[k] == sorted(got[k]) and set(x[0] for x in got[k] if x in exact[k]) <= {x[0] for x in exact[k]}
    assert measured == pytest.approx(sum(len({x[1] for x in got[k]} & {x[1] for x in exact[k]}) for k in asked) / (5 * len(asked)))
    # Of 1000 copies six are hashed.
    assert 0 < lsh.lsh_comparisons(df, "key", "vector", 5, hashing) < 0.5 * 12 * 2006**2
    some = lsh.nearest_neighbors_lsh(df, "key", "vector", 5, ["c"], queries=F.col("label") == 1, hashing=hashing)
    assert lists(some) == {k: v for k, v in got.items() if k % 9 == 0}


def test_lsh_vectors_travel_once_a_part_and_slice(spark, monkeypatch):
    """Not once for each table and group of codes; what is found does not depend on the dealing."""
    for size in (10_000, 100_000, 400_000):
        assert sum(lsh._cells(size, 64, lsh.Hashing.for_size(size))) <= 16
    rows = cloud(600, 6, 5, copies=60)
    df = spark.createDataFrame(rows, "key long, label int, vector array<double>, c string")
    hashing = lsh.Hashing(5, 8, 12)
    seen, search = spark.sparkContext.accumulator(0), lsh._search

    def counting(*given):
        answer = search(*given)

        def run(visitors, hosts):
            seen.add(len(visitors) + len(hosts))
            return answer(visitors, hosts)

        return run

    monkeypatch.setattr(lsh, "_search", counting)
    whole = lists(lsh.nearest_neighbors_lsh(df, "key", "vector", 4, ["c"], hashing=hashing))
    assert 0 < seen.value <= 600 * sum(lsh._cells(600, 6, hashing))
    monkeypatch.setattr(lsh, "GROUP_ROWS", 100)
    monkeypatch.setattr(lsh, "SLICE_CODES", 600)
    assert lsh._cells(600, 6, hashing) == (6, 12)
    assert lists(lsh.nearest_neighbors_lsh(df, "key", "vector", 4, ["c"], hashing=hashing)) == whole


def test_lsh_groups_and_slices(spark, monkeypatch):
    rows = cloud(400, 4, 3)
    df = spark.createDataFrame(rows, "key long, label int, vector array<double>, c string")
    hashing = lsh.Hashing(6, 5, 32)  # all buckets: exact
    assert lists(lsh.nearest_neighbors_lsh(df, "key", "vector", 3, ["c"], hashing=hashing)) == brute_lists(rows, 3, lambda r: True)
    monkeypatch.setattr(lsh, "GROUP_ROWS", 40)
    monkeypatch.setattr(lsh, "SLICE_ROWS", 16)
    assert lists(lsh.nearest_neighbors_lsh(df, "key", "vector", 3, ["c"], hashing=hashing)) == brute_lists(rows, 3, lambda r: True)
    empty = df.limit(0)
    assert lsh.nearest_neighbors_lsh(empty, "key", "vector", 3, ["c"]).count() == 0
    assert lsh._cheapest(3, 99) == sorted(lsh._cheapest(3, 99), key=lambda s: sum((i + 1) ** 2 for i in s)) and len(lsh._cheapest(3, 99)) == 8
    sizes = [lsh.Hashing.for_size(n) for n in (1, 500, 10**4, 10**6, 10**9)]
    share = [h.tables * h.probes / 2**h.bits for h in sizes]
    assert share[1:] == sorted(share[1:], reverse=True) and share[-1] < 0.05


@pytest.mark.parametrize("repeats, small", [(False, True), (True, True), (True, False)])
def test_answers_are_found_by_key_not_by_vector(spark, monkeypatch, repeats, small):
    """Only vectors that are there more than once may be shuffled to meet their equals."""
    x = np.random.default_rng(8).normal(size=(300, 5))
    if repeats:
        x[20:32] = x[10]
        x[40:43] = 0.0
        x[41, 2] = -0.0
    if not small:
        monkeypatch.setattr(N, "BROADCAST_BYTES", 0)
    df = frame(spark, x, np.arange(300) % 3 == 0)
    near = N.nearest_neighbors(df, "key", "vector", 4, ["label"], F.col("label") == 1, block_rows=20, few_bytes=0)
    assert answer(near) == brute(x, 4, range(0, 300, 3))
    if not repeats:
        plan = near.select("key", "neighbors")._jdf.queryExecution().executedPlan().toString()
        dealt = re.findall(r"hashpartitioning\(.*", plan)
        assert dealt and not any("vector" in by for by in dealt)


def test_a_point_travels_to_few_groups():
    for size in (20_000, 200_000, 600_000):
        _, n_blocks, in_group = N._layout(size, N.BLOCK_ROWS, 64)
        assert -(-n_blocks // in_group) <= 5


def test_oversampling_searches_without_carrying_vectors(spark, monkeypatch):
    """Lists of vectors would travel once for every group; the few that are wanted join at the end."""
    rng = np.random.default_rng(9)
    y = (np.arange(240) % 4 == 0).astype(int)
    df = frame(spark, rng.normal(size=(240, 3)), y)
    asked, real = [], R.nearest_neighbors
    monkeypatch.setattr(R, "nearest_neighbors", lambda *a, **b: asked.append(b) or real(*a, **b))
    made = R.borderline_smote(df)
    assert made.where("synthetic").count() == 120
    assert len(asked) == 2 and not any(b.get("with_vectors") for b in asked)


def _peak(work):
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 2**20
    finally:
        tracemalloc.stop()


SOME_ROWS = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("vector", T.ArrayType(T.DoubleType())),
        T.StructField("label", T.IntegerType()),
    ]
)


def _some_rows(x, at=0):
    return {
        "key": pa.array(np.arange(at, at + len(x))),
        "vector": pa.array(list(x), pa.list_(pa.float64())),
        "label": pa.array(np.zeros(len(x), np.int32)),
    }


def test_a_scan_works_on_the_lists_of_few_queries_at_a_time(monkeypatch):
    """Beside the lists that are kept (24 bytes an entry), memory doesn't grow with the queries."""
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    rng = np.random.default_rng(12)
    q, k = rng.normal(size=(24_000, 4)), 11
    parts = [rng.normal(size=(400, 4)) for _ in range(3)]
    batches = [pa.RecordBatch.from_pydict(_some_rows(x, 400 * i)) for i, x in enumerate(parts)]
    out = []
    assert _peak(lambda: out.extend(N._scan_for(N._Shape(SOME_ROWS, ["label"], False), q, k)(batches))) < 20
    got = pa.Table.from_batches(out)
    assert got.column("_q").to_pylist() == list(range(24_000)) and set(got.column("_part").to_pylist()) == {3}
    x = np.concatenate(parts)
    for i in (0, 4095, 4096, 23_999):
        want = np.argsort(((x - q[i]) ** 2).sum(axis=1), kind="stable")[:k]
        assert [e["key"] for e in got.column("neighbors")[i].as_py()] == want.tolist()


def test_a_group_answers_some_visitors_at_a_time():
    rng = np.random.default_rng(13)
    n, k = 60_000, 11
    q, c = rng.normal(size=(n, 4)), rng.normal(size=(300, 4))
    hosts = pa.table(_some_rows(c) | {"block": pa.array(np.arange(300, dtype=np.int32) // 100)})
    blocks = pa.array([[]] * (n - 1) + [[0, 2]], pa.list_(pa.int32()))
    visitors = pa.table(_some_rows(q, 1000) | {"bound": pa.array(np.full(n, np.inf)), "blocks": blocks}).drop(["label"])
    answer, out = N._visit(N._Shape(SOME_ROWS, ["label"], False), k), []
    assert _peak(lambda: out.append(answer(visitors, hosts))) < 60
    assert out[0].column("key").to_pylist() == list(range(1000, 1000 + n))
    for i in (0, 16_383, 16_384, n - 1):
        near = ((c - q[i]) ** 2).sum(axis=1)
        if i == n - 1:
            near[100:200] = np.inf
        assert [e["key"] for e in out[0].column("neighbors")[i].as_py()] == np.argsort(near, kind="stable")[:k].tolist()
    assert answer(visitors.slice(0, 0), hosts).num_rows == 0

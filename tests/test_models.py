import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tierwise.operators import boosting as B, explain as X, isotonic, search as S, tiers
from tierwise.plans.catalog.modelling import LEAVES
from tierwise.plans.scoring import score_records
from tierwise.plans.training import RunConfig, run_training
from tierwise.sources import files
from tierwise.sources.run_store import RunStore
from tierwise.streaming.scoring import read_record_stream, score_stream


def make_leaf(tree, leaf, value, cover, path):
    return X.Leaf(value, [p[0] for p in path], *(np.array([p[i] for p in path], dtype=float) for i in (1, 2, 3)))


def shapley(game, d):
    out = np.zeros(d)
    for i in range(d):
        rest = [j for j in range(d) if j != i]
        for size in range(d):
            for s in itertools.combinations(rest, size):
                w = math.factorial(size) * math.factorial(d - size - 1) / math.factorial(d)
                out[i] += w * (game({*s, i}) - game(set(s)))
    return out


@pytest.fixture(scope="module")
def leaves():
    return [make_leaf(*row) for row in LEAVES]


def points(n, seed):
    rng = np.random.default_rng(seed)
    return np.column_stack([rng.random(n) * 120, rng.integers(0, 150, n), rng.integers(0, 24, n)]).astype(float)


def test_interventional_values_equal_brute_force(leaves):
    x, background = points(6, 0), points(9, 1)
    got = X._leaf_sums(leaves, [X.interventional_weights(leaf, background) for leaf in leaves], x)
    for row, phi in zip(x, got):

        def game(s, row=row):
            mixed = background.copy()
            mixed[:, list(s)] = row[list(s)]
            return X.margin(leaves, mixed).mean()

        assert np.allclose(phi, shapley(game, 3))
    assert np.allclose(got.sum(axis=1) + X.interventional_base(leaves, background), X.margin(leaves, x))


def test_path_values_equal_brute_force(leaves):
    x = points(6, 2)
    got = X._leaf_sums(leaves, [X.path_weights(leaf) for leaf in leaves], x)
    for row, phi in zip(x, got):

        def game(s, row=row):
            total = 0.0
            for leaf in leaves:
                part = leaf.value
                for j, f in enumerate(leaf.features):
                    inside = leaf.low[j] < row[f] <= leaf.high[j]
                    part *= float(inside) if f in s else leaf.ratio[j]
                total += part
            return total

        assert np.allclose(phi, shapley(game, 3))
    assert np.allclose(got.sum(axis=1) + X.path_base(leaves), X.margin(leaves, x))


def test_no_background_gives_zeros(leaves):
    assert not X.interventional_weights(leaves[0], np.zeros((0, 3))).any()


def random_leaves(n, d, width, seed):
    r = np.random.default_rng(seed)
    features = np.sort(np.argsort(r.random((n, width)), axis=1)[:, :d], axis=1)
    low = r.normal(size=(n, d)) - 1
    ratio = r.uniform(0, 1, (n, d)) * (r.random((n, d)) > 0.1)
    return [X.Leaf(float(r.normal()), f.tolist(), a, a + 2, q) for f, a, q in zip(features, low, ratio)]


def test_contributions_without_tables_equal_tables(monkeypatch):
    leaves = [*random_leaves(40, 5, 9, 1), *random_leaves(20, 3, 9, 2), X.Leaf(2.0, [], np.zeros(0), np.zeros(0), np.zeros(0))]
    packed = X.PackedLeaves.of(leaves)
    assert [leaf.features for leaf in packed] == [leaf.features for leaf in leaves]
    x = np.random.default_rng(3).normal(size=(300, 9))
    background = x[:50]
    want = X._leaf_sums(leaves, [X.path_weights(leaf) for leaf in leaves], x)
    against = X._leaf_sums(leaves, [X.interventional_weights(leaf, background) for leaf in leaves], x)
    for few in (0, 1000):  # by masks, and row by row
        monkeypatch.setattr(X, "FEW_ROWS", few)
        monkeypatch.setattr(X, "CELLS", 1000)
        assert np.allclose(X.leaf_sums_without_tables(packed, x), want)
        assert np.allclose(X.leaf_sums_without_tables(packed, x, background), against)
        assert not X.leaf_sums_without_tables(packed, x[:0]).size


def test_large_ensembles_take_little_memory(spark, monkeypatch):
    import tracemalloc

    # A sixth of 900 trees of depth 8; memory is in proportion to the leaves.
    leaves = random_leaves(150 * 256, 8, 20, 4)
    packed = X.PackedLeaves.of(leaves)
    assert packed.table_bytes() > 9 * X.TABLE_BYTES
    x = np.random.default_rng(5).normal(size=(3, 20))
    tracemalloc.start()
    got = X.leaf_sums_without_tables(packed, x)
    assert tracemalloc.get_traced_memory()[1] < 80 << 20
    tracemalloc.stop()
    held = sum(a.nbytes for a in (packed.values, packed.first, packed.features, packed.low, packed.high, packed.ratio))
    assert held * 6 < 100 << 20
    chosen = leaves[::200]
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "key long, x array<double>")
    monkeypatch.setattr(X, "TABLE_BYTES", 0)
    few = {r["key"]: r["s"] for r in df.select("key", X.shap_values(F.col("x"), chosen).alias("s")).collect()}
    want = X._leaf_sums(chosen, [X.path_weights(leaf) for leaf in chosen], x)
    assert all(np.allclose(few[i], want[i]) for i in few) and np.isfinite(got).all()


@pytest.fixture(scope="module")
def records_table(spark):
    """Records shaped like the sample record, with a rare target that depends on them."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(260):
        age, sugar = float(rng.integers(20, 90)), float(np.round(rng.normal(110, 35), 2))
        risk = (age > 65) * 0.35 + (sugar > 150) * 0.3 + 0.03
        bmi = None if i % 9 == 0 else float(np.round(rng.normal(28, 5), 1))
        smoke = [None, "never smoked", "smokes", "formerly smoked"][int(rng.integers(0, 4))]
        rows.append((i, ["Male", "Female"][i % 2], age, int(age > 60), sugar, bmi, smoke, int(rng.random() < risk)))
    return spark.createDataFrame(
        rows,
        "id long, gender string, age double, hypertension int, avg_glucose_level double, bmi double, "
        "smoking_status string, outcome int",
    )


SMALL = {"n_estimators": 4, "max_depth": 3}


@pytest.fixture(scope="module")
def run(spark, records_table, tmp_path_factory):
    config = RunConfig(
        "outcome", "id", n_splits=2, n_trials=1, categorical_rounds=1, categorical_trees=2,
        params=SMALL, search_limits={**SMALL, "reg_alpha": 0.0, "reg_lambda": 1.0}, explained=40, background=60,
    )
    store = RunStore(spark, str(tmp_path_factory.mktemp("runs")))
    return run_training(records_table, config, store, "run_a"), store


def test_a_run_reports_everything(run):
    made, store = run
    assert made.metrics.first()["tp"] + made.metrics.first()["fn"] > 0
    assert made.stratified.count() == made.split.where("split = 'test'").count()
    assert made.tier_summary.agg(F.sum("count")).first()[0] == made.stratified.count()
    assert made.baseline.count() == 2 and made.baseline_summary.count() == 8
    assert made.search.trials.where("state = 'complete'").count() == 1
    assert set(made.search.best_sampler) == {"allknn_n_neighbors", "allknn_kind_sel"}
    assert made.top_local.count() <= 10
    for name in ("metrics", "tiers", "threshold", "trials", "data_audit", "tiered_rows"):
        assert store.report(name).where("run_id = 'run_a'").count() > 0
    with pytest.raises(FileNotFoundError):
        store.report("nothing")


def test_shapley_values_of_a_run_add_up_to_the_margin(spark, run, records_table):
    made, _ = run
    prepare, trees = made.model.stages
    model_leaves = X.read_leaves(X.leaf_table(spark, trees))
    ready = trees.transform(prepare.transform(records_table)).select(
        vector_to_array("features").alias("x"), F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("m")
    )
    pdf = ready.withColumn("shap", X.shap_values(F.col("x"), model_leaves)).toPandas()
    total = np.stack(pdf["shap"]).sum(axis=1) + X.path_base(model_leaves)
    assert np.abs(total - pdf["m"]).max() < 1e-9
    long = made.shap.groupBy("key").agg(F.sum("shap_value").alias("s"))
    assert long.count() == 40


def test_records_are_scored_in_batch_and_as_a_stream(spark, run, records_table, tmp_path):
    made, store = run
    record = store.resolve()
    model = store.load(record)
    model_leaves = X.read_leaves(X.leaf_table(spark, model.stages[1]))
    asked = records_table.drop("outcome").limit(30)
    high = [{**t, "min_prob": t["min_prob"] + 0.5} for t in record.tiers]
    batch = score_records(asked, model, model_leaves, record.threshold, high, "id", record.run_id, 3)
    rows = batch.collect()
    assert len(rows) == 30 and all(len(r["explanation"]) == 3 for r in rows)
    for r in rows:
        assert r["predicted_label"] == int(r["predicted_probability"] >= record.threshold)
        below = r["predicted_probability"] < min(t["min_prob"] for t in high)
        assert (r["risk_tier"] is None) == below
        sizes = [abs(e["shap_value"]) for e in r["explanation"]]
        assert sizes == sorted(sizes, reverse=True)
    asked.write.json(str(tmp_path / "in"))
    records = read_record_stream(spark, str(tmp_path / "in"), asked.schema)
    query = score_stream(
        records, model, model_leaves, record.threshold, high, str(tmp_path / "out"), str(tmp_path / "cp"), "id", record.run_id
    )
    assert query.awaitTermination(120)
    streamed = {r["key"]: r["predicted_probability"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert streamed == pytest.approx({r["key"]: r["predicted_probability"] for r in rows})


def test_runs_are_found_by_name_then_latest_then_unnamed_then_only(spark, run, tmp_path):
    made, _ = run
    store = RunStore(spark, str(tmp_path / "store"))
    with pytest.raises(FileNotFoundError):
        store.resolve()
    args = (made.model.stages[0], 0.5, "pr_auc", ["age"], [], {}, [])
    store.save(None, *args)
    assert store.resolve().run_id is None
    store.save("a", *args)
    store.save("b", *args)
    assert store.resolve().run_id == "b" and store.resolve("a").run_id == "a"
    with pytest.raises(FileNotFoundError):
        store.resolve("c")
    alone = RunStore(spark, str(tmp_path / "alone"))
    alone.save("x", *args)
    spark.createDataFrame([(9, "gone")], "number long, run_id string").withColumn("saved_at", F.current_timestamp()).write.mode(
        "append"
    ).parquet(f"{alone.root}/commits")
    assert alone.resolve().run_id == "x"


def test_a_reader_between_two_commits_finds_the_last_one(spark, run, tmp_path, monkeypatch):
    made, _ = run
    root = str(tmp_path / "store")
    one, two, reader = (RunStore(spark, root) for _ in range(3))
    args = (made.model.stages[0], 0.5, "pr_auc", ["age"], [], {}, [])
    one.save("a", *args)
    seen = []
    point_at = RunStore._point_at

    def interleaved(self, run_id):
        # The other writer's record is there and its commit is not; then both give the same number.
        seen.append(reader.resolve().run_id)
        if run_id == "b":
            last = self._last_commit()
            monkeypatch.setattr(RunStore, "_last_commit", lambda store: last)
            point_at(two, "c")
            point_at(self, "b")
            monkeypatch.undo()
        else:
            point_at(self, run_id)

    monkeypatch.setattr(RunStore, "_point_at", interleaved)
    two.save("c", *args)
    one.save("b", *args)
    assert seen == ["a", "c"]
    numbers = [r["number"] for r in spark.read.parquet(f"{root}/commits").orderBy("saved_at").collect()]
    assert numbers == [1, 2, 3, 3] and reader.resolve().run_id == "b"


def test_settings_are_merged_and_checked():
    assert B.boosting_params({"max_depth": 6})["max_depth"] == 6
    assert B.boosting_params()["n_estimators"] == 400
    with pytest.raises(ValueError):
        B.boosting_params({"allknn_n_neighbors": 3})
    with pytest.warns(UserWarning):
        B.boosting_params({"reg_alpha": 1.0})


def test_isotonic_blocks_equal_plain_pooling(spark):
    r = np.random.default_rng(2)
    p = np.round(r.random(4000), 3)
    y = (r.random(4000) < p * p).astype(int)
    df = spark.createDataFrame([(int(b), float(a)) for a, b in zip(p, y)] + [(1, None)], "y int, p double")
    xs = np.unique(p)
    sums, counts = (np.array([f[p == x].sum() for x in xs]) for f in (y, np.ones(4000)))
    plain = []
    for x, s, n in zip(xs, sums, counts):
        plain.append([x, x, s, n])
        while len(plain) > 1 and plain[-2][2] / plain[-2][3] >= plain[-1][2] / plain[-1][3] - 1e-15:
            b = plain.pop()
            plain[-1] = [plain[-1][0], b[1], plain[-1][2] + b[2], plain[-1][3] + b[3]]
    want = [(a, b, s / n, n) for a, b, s, n in plain]
    for ranges in (1, 3, 64, 100):
        blocks = isotonic.isotonic_blocks(B.by_score(df), ranges)
        assert np.allclose([tuple(r) for r in blocks.orderBy("low").collect()], want)
    # Prediction between and beyond the blocks, in one bin and in many.
    asked = [None, -1.0, 0.0, 0.12345, 0.5, 0.77777, 1.0, 9.0]
    ends = [e for a, b, _, _ in plain for e in (a, b)]
    levels = [v for v in (s / n for *_, s, n in plain) for _ in range(2)]
    scored = spark.createDataFrame([(a, 1) for a in asked], "p double, _held int")
    found = isotonic.predict_isotonic(scored.drop("_held"), blocks).collect()
    for row in found:
        assert row["calibrated"] is None if row["p"] is None else row["calibrated"] == pytest.approx(np.interp(row["p"], ends, levels))
    assert len(found) == len(asked)
    none = B.calibrate_isotonic(df.limit(0), df)
    assert none.where("calibrated is null").count() == 4001


def test_shap_distribution_and_constant_features(spark):
    rows = [(i, [float(i), 1.0], [i / 10.0, 0.5]) for i in range(101)]
    df = spark.createDataFrame(rows, "key long, x array<double>, shap array<double>")
    a, b = X.shap_distribution(df, ["a", "b"], (0.05, 0.5, 0.95)).collect()
    assert (a["feature"], a["n"], a["q05"], a["q50"], a["q95"], round(a["direction"], 9)) == ("a", 101, 0.5, 5.0, 9.5, 1.0)
    assert (b["mean_shap"], b["q05"], b["q95"], b["direction"]) == (0.5, 0.5, 0.5, None)
    assert [r["q05"] for r in X.shap_distribution(df.limit(0), ["a", "b"], (0.05,)).collect()] == [None, None]


def test_calibration_is_monotone_and_keeps_the_mean(spark):
    rows = [(i, int(i % 10 < i // 30), i / 300.0) for i in range(300)]
    df = spark.createDataFrame(rows, "key long, y int, p double")
    iso = B.calibrate_isotonic(df, df).orderBy("p").toPandas()
    assert (np.diff(iso["calibrated"]) >= -1e-12).all()
    assert iso["calibrated"].mean() == pytest.approx(iso["y"].mean())
    platt = B.calibrate_sigmoid(df, df).orderBy("p").toPandas()
    assert (np.diff(platt["calibrated"]) > 0).all()
    n1 = int(platt["y"].sum())
    target = np.where(platt["y"] == 1, (n1 + 1) / (n1 + 2), 1 / (300 - n1 + 2))
    assert platt["calibrated"].mean() == pytest.approx(target.mean(), abs=1e-5)


def test_trials_stay_in_their_ranges(spark):
    trials = S.search_trials(spark.range(200).withColumnRenamed("id", "trial"), "smote_ncr")
    row = trials.agg(
        F.min("model.n_estimators"), F.max("model.n_estimators"), F.min("model.learning_rate"),
        F.max("model.learning_rate"), F.min("sampler.ncr_n_neighbors"), F.max("sampler.ncr_n_neighbors"),
    ).first()
    assert 150 <= row[0] and row[1] <= 900 and 1e-3 <= row[2] and row[3] <= 0.2 and (row[4], row[5]) == (3, 7)
    assert "sampler" not in S.search_trials(spark.range(1).withColumnRenamed("id", "trial"), "none").columns


def test_csv_round_trip_types_and_nulls(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    with open(path, "w") as f:
        f.write('id,bmi,flag,name,empty\n1,N/A,True,"a,b",\n2,31.5,False,"say ""hi""",NULL\n3,1e1,true,Unknown,nan\n')
    df = files.read_csv(spark, path)
    assert dict(df.dtypes) == {"id": "bigint", "bmi": "double", "flag": "boolean", "name": "string", "empty": "string"}
    rows = df.orderBy("id").collect()
    assert [r["bmi"] for r in rows] == [None, 31.5, 10.0]
    assert [r["name"] for r in rows] == ["a,b", 'say "hi"', "Unknown"]
    assert all(r["empty"] is None for r in rows)
    files.write_csv(df, str(tmp_path / "out"))
    assert files.read_csv(spark, str(tmp_path / "out")).exceptAll(df).isEmpty()
    pinned = files.read_csv(spark, path, "id int, bmi double")
    assert dict(pinned.dtypes) == {"id": "int", "bmi": "double"}
    with pytest.raises(ValueError):
        files.read_csv(spark, path, "age double")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        files.read_csv(spark, str(tmp_path / "absent.csv"))


def test_reports_records_and_splits_on_disk(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "train"), (2, 0.5, "test")], "id long, v double, split string")
    files.write_report(df, str(tmp_path / "report"))
    assert '"v":null' in "".join(r[0] for r in spark.read.text(str(tmp_path / "report")).collect())
    one = tmp_path / "one.json"
    one.write_text('{\n  "gender": "Male",\n  "age": 67.0\n}\n')
    record = files.read_records(spark, str(one), "gender string, age double, bmi double").collect()
    assert len(record) == 1 and record[0]["age"] == 67.0 and record[0]["bmi"] is None
    files.write_splits(df, str(tmp_path / "splits"))
    assert sorted(p.name for p in (tmp_path / "splits").glob("split=*")) == ["split=test", "split=train"]
    nan = spark.createDataFrame([(float("nan"), 1)], "a double, b int")
    assert files.nan_to_null(nan).first()["a"] is None


def test_tier_texts_stay_complete():
    assert [t["priority"] for t in tiers.default_tiers()] == [1, 2, 3, 4]

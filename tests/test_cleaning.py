import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tierwise.functions import sizes
from tierwise.operators import cleaning, imputation
from tierwise.operators.preprocessing import build_preprocessor, feature_names


@pytest.fixture(scope="module")
def gaps(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    x[:, 2] = x[:, 0] * 2 - x[:, 1] + 0.1 * rng.normal(size=400)
    rows = []
    for i, r in enumerate(x):
        v = [float(e) for e in r]
        if i % 5 == 0:
            v[2] = None
        if i % 7 == 0:
            v[1] = None
        rows.append((i, *v))
    return spark.createDataFrame(rows, "key long, a double, b double, c double")


def test_clip_keeps_missing_and_stays_in_bounds(spark, gaps):
    model = cleaning.QuantileClipper(inputCols=["a", "b"], lower=0.1, upper=0.9).fit(gaps)
    out = model.transform(gaps)
    assert out.where("b is null").count() == gaps.where("b is null").count()
    low, high = model.values["a"]
    found = out.agg(F.min("a"), F.max("a")).first()
    assert (found[0], found[1]) == (low, high)


def test_clip_wants_numbers(spark):
    with pytest.raises(ValueError, match="numeric"):
        cleaning.QuantileClipper(inputCols=["s"]).fit(spark.createDataFrame([("x",)], "s string"))


def _numpy_chain(x, rounds):
    """Plain chained least squares, row by row."""
    x = x.copy()
    gap = np.isnan(x)
    med = np.nanmedian(x, axis=0)
    x[gap] = np.take(med, np.nonzero(gap)[1])
    for _ in range(rounds):
        for c in np.argsort(gap.sum(axis=0), kind="stable"):
            others = [j for j in range(x.shape[1]) if j != c]
            known = ~gap[:, c]
            design = np.column_stack([np.ones(known.sum()), x[known][:, others]])
            beta = np.linalg.lstsq(design, x[known, c], rcond=None)[0]
            x[gap[:, c], c] = beta[0] + x[gap[:, c]][:, others] @ beta[1:]
    return x


def test_linear_chain_equals_row_wise_regressions(spark, gaps):
    chain = imputation.ChainedLinearImputer(inputCols=["a", "b", "c"], maxIter=4, tol=0.0, solver="least_squares")
    out = chain.fit(gaps).transform(gaps).orderBy("key").toPandas()[["a", "b", "c"]].to_numpy()
    want = _numpy_chain(gaps.orderBy("key").toPandas()[["a", "b", "c"]].to_numpy(dtype=float), 4)
    assert np.abs(out - want).max() < 1e-9


def test_linear_chain_leaves_known_cells_and_fills_the_rest(spark, gaps):
    model = imputation.ChainedLinearImputer(inputCols=["a", "b", "c"]).fit(gaps)
    out = model.transform(gaps)
    assert out.where("a is null or b is null or c is null").isEmpty()
    both = out.select("key", *[F.col(c).alias(f"n{c}") for c in "abc"]).join(gaps, "key")
    assert both.where("a <> na or (b is not null and b <> nb) or (c is not null and c <> nc)").isEmpty()
    # A column complete in training is imputed when scoring.
    one = spark.createDataFrame([(1, None, 0.5, None)], "key long, a double, b double, c double")
    assert all(v is not None for v in model.transform(one).first())


def test_patterns_kept_in_spark_give_the_same_chain(spark, gaps):
    rows = gaps.select(*[(F.col(c) - 0.1).alias(f"x{i}") for i, c in enumerate("abc")])
    near = imputation._PatternTable(rows, 3)
    far = imputation._PatternTable(rows, 3, driver_cells=10)
    assert near.spread is None and far.spread is not None
    assert near.missing.tolist() == far.missing.tolist()
    order = np.argsort(near.missing, kind="stable").tolist()
    for solver in imputation.SOLVERS:
        a = near.chain(order, 2, solver, 0.0)
        b = far.chain(order, 2, solver, 0.0)
        for s, t in zip(a, b):
            assert s[0] == t[0] and np.allclose([s[1], *s[2]], [t[1], *t[2]])


def test_rounds_end_early_when_nothing_moves(spark, gaps):
    short = imputation.ChainedLinearImputer(inputCols=["a", "b", "c"], tol=0.5, solver="least_squares").fit(gaps)
    full = imputation.ChainedLinearImputer(inputCols=["a", "b", "c"], tol=0.0, solver="least_squares").fit(gaps)
    assert len(short.values["steps"]) < len(full.values["steps"]) == 60


def test_bayesian_ridge_approaches_least_squares_with_many_rows(spark, gaps):
    kw = dict(inputCols=["a", "b", "c"], tol=0.0, maxIter=2)
    a = imputation.ChainedLinearImputer(solver="bayesian", **kw).fit(gaps).values["steps"]
    b = imputation.ChainedLinearImputer(solver="least_squares", **kw).fit(gaps).values["steps"]
    assert np.allclose(a[-1][2], b[-1][2], atol=0.02) and a[-1][2] != b[-1][2]


def test_unknown_solver_is_an_error(spark, gaps):
    with pytest.raises(ValueError, match="solver"):
        imputation.ChainedLinearImputer(inputCols=["a"], solver="guess").fit(gaps)


def test_mode_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("a",)], "s string")
    assert cleaning.modes(df, ["s"]) == {"s": "a"}
    assert cleaning.impute_mode(df, ["s"]).where("s = 'a'").count() == 3


def test_codes_of_unseen_and_missing_categories(spark):
    known = spark.createDataFrame([("b",), ("a",), ("c",)], "s string")
    model = cleaning.OrdinalEncoder(inputCols=["s"]).fit(known)
    asked = spark.createDataFrame([("a",), ("c",), ("z",), (None,)], "s string")
    assert [r[0] for r in model.transform(asked).collect()] == [0.0, 2.0, -1.0, None]


def test_decode_rounds_half_to_even_and_stays_in_range(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-4.0,), (9.0,)], "v double")
    known = cleaning.Dictionary.fit(spark.createDataFrame([(v,) for v in "srqp"], "s string"), ["s"])
    out = {r["v"]: r["t"] for r in known.decode(df, {"t": (F.col("v"), "s")}).collect()}
    assert out == {0.5: "p", 1.5: "r", 2.5: "r", -4.0: "p", 9.0: "s"}


def test_dictionary_of_many_categories_is_joined_and_not_broadcast(spark, monkeypatch):
    df = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("s"), F.lit("x").alias("t"), F.lit(None).cast("string").alias("u"))
    monkeypatch.setattr(sizes, "BROADCAST_BYTES", 0)
    known = cleaning.Dictionary.fit(df, ["s", "t", "u"])
    assert known.sizes == {"s": 20000, "t": 1, "u": 0} and not known.small
    want = {v: float(i) for i, v in enumerate(sorted(f"k{i}" for i in range(20000)))}
    coded = known.encode(df, {"a": "s", "b": "t", "c": "u"})
    assert {r["s"]: r["a"] for r in coded.collect()} == want
    assert coded.where("b <> 0 or c is not null").isEmpty()
    back = known.decode(coded, {"z": (F.col("a"), "s"), "w": (F.col("a"), "u")})
    assert back.count() == 20000 and back.where("z <> s or w is not null").isEmpty()


def test_category_chain_uses_what_other_columns_say(spark, tmp_path, monkeypatch):
    rows = [(i, "xyz"[i % 3] if i % 10 else None, "uvw"[i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, "key long, s string, t string")
    chain = imputation.ChainedCategoryImputer(inputCols=["s", "t"], maxIter=1, numTrees=3)
    model = chain.fit(df)
    monkeypatch.setattr(imputation, "checkpointed", None)  # a transform is lazy
    out = model.transform(df)
    assert out.where("s is null").isEmpty() and out.count() == 300
    assert out.where("translate(t, 'uvw', 'xyz') <> s").isEmpty()
    # Rows by themselves give what the combinations seen in training give.
    none = imputation.ChainedCategoryImputerModel(
        ["s", "t"], model.learned, model.forests, model.dictionary, model.seen.limit(0)
    )
    assert none.transform(df).exceptAll(out).isEmpty() and none.transform(df).count() == 300
    # An unseen category is imputed like a missing one.
    new = spark.createDataFrame([(1, "other", "v"), (2, None, None)], "key long, s string, t string")
    got = {r["key"]: (r["s"], r["t"]) for r in model.transform(new).collect()}
    assert got[1] == ("y", "v") and got[2][0] in "xyz" and got[2][1] in "uvw"
    model.write().overwrite().save(str(tmp_path / "chain"))
    again = imputation.ChainedCategoryImputerModel.load(str(tmp_path / "chain"))
    assert again.transform(df).exceptAll(out).isEmpty()


def test_preprocessor_order_persistence_and_leakage(spark, tmp_path):
    rows = [(i, float(i % 17) if i % 6 else None, "ab"[i % 2], i % 2 == 0) for i in range(120)]
    df = spark.createDataFrame(rows, "key long, n double, s string, flag boolean")
    train, held = df.where("key < 90"), df.where("key >= 90")
    build = build_preprocessor(["n", "flag"], ["s"], categorical_rounds=1, categorical_trees=2)
    model = build.fit(train)
    assert feature_names(model) == ["n", "flag", "s"]
    before = [s.values for s in model.stages if hasattr(s, "values")]
    changed = held.withColumn("n", F.lit(1e9))
    after = [s.values for s in build.fit(train).stages if hasattr(s, "values")]
    assert before == after
    assert model.transform(changed).agg(F.max("n")).first()[0] <= 16.0
    model.write().overwrite().save(str(tmp_path / "prep"))
    again = PipelineModel.load(str(tmp_path / "prep"))
    a, b = (m.transform(held).select("key", "features").orderBy("key").collect() for m in (model, again))
    assert a == b

"""Boosted trees, cross-validation, search, and their explanations."""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tierwise.functions.lineage import checkpointed
from tierwise.operators import boosting, explain, search, tiers
from tierwise.operators.preprocessing import build_preprocessor
from tierwise.operators.split import stratified_split, train_and_valid
from tierwise.operators.thresholds import select_threshold
from tierwise.plans.catalog.bindings import documents, rounded, table
from tierwise.plans.scoring import score_records

NUMERIC = ["n_chars", "n_words", "n_unique", "n_lines"]
CATEGORICAL = ["lang", "source"]
# Parameters of the queries below: few trees, rounds, folds and trials, over whole tables.
SMALL_TREES = {"n_estimators": 5, "max_depth": 3, "scale_pos_weight": 7.0, "learning_rate": 0.2}
STUMP = {
    "n_estimators": 1, "max_depth": 1, "scale_pos_weight": 7.0, "min_child_weight": 1.0,
    "subsample": 1.0, "colsample_bytree": 1.0,
}


def _spec(target: str = "toxic", strategy: str = "none", **kw) -> boosting.TrainSpec:
    return boosting.TrainSpec(
        target, "key", NUMERIC, CATEGORICAL, dict(SMALL_TREES), strategy,
        categorical_rounds=1, categorical_trees=2, **kw,
    )


def gbt_fit_score(spark, sf):
    """Trees on the numeric columns alone, scoring the rows they were fitted on."""
    rows = documents(spark, sf).select(
        "key", F.col("toxic").alias("label"), F.array(*NUMERIC).alias("vector")
    )
    model = boosting.fit_boosted(rows, SMALL_TREES)
    ready = rows.withColumn("features", boosting.array_to_vector("vector"))
    out = model.transform(ready).select("key", F.col("label").alias("y"), boosting.positive_probability().alias("p"))
    return rounded(out)


def _stump(spark, sf):
    """One split of a column of 24 whole numbers, so that SQL can try every cut."""
    rows = table(spark, sf, "events").select(
        F.col("event_id").alias("key"),
        (F.col("value") > (F.col("event_id") % 24) * 4).cast("int").alias("label"),
        F.array((F.col("event_id") % 24).cast("double")).alias("vector"),
    )
    return rows, boosting.fit_boosted(rows, STUMP)


STUMP_SQL = """with e as (select event_id as key, event_id % 24 as h, cast(value > (event_id % 24) * 4 as int) as y from events),
 g as (select h, sum(case when y = 1 then 7.0::double else 1 end) as w,
   sum(case when y = 1 then 7.0::double else -1 end) as s from e group by h),
 c as (select a.h as cut, sum(b.w) filter (b.h <= a.h) as wl, sum(b.s) filter (b.h <= a.h) as sl,
   sum(b.w) filter (b.h > a.h) as wr, sum(b.s) filter (b.h > a.h) as sr from g a, g b group by a.h),
 t as (select * from c where wr is not null order by sl * sl / wl + sr * sr / wr desc, cut limit 1)"""


def gbt_stump_score(spark, sf):
    rows, model = _stump(spark, sf)
    ready = rows.withColumn("features", boosting.array_to_vector("vector"))
    out = model.transform(ready).select("key", F.col("label").alias("y"), boosting.positive_probability().alias("p"))
    return rounded(out)


def leaf_table_stump(spark, sf):
    _, model = _stump(spark, sf)
    leaves = explain.leaf_table(spark, model).withColumn("part", F.get("path", F.lit(0)))
    return rounded(
        leaves.select("tree", "leaf", "value", "cover", F.col("part.ratio").alias("ratio"), "part.low", "part.high")
        .withColumn("cut", F.when(F.col("leaf") == 1, F.col("high")).otherwise(F.col("low")))
        .drop("low", "high")
    )


def shap_stump_base(spark, sf):
    """Base values of a fitted model: mean margin of the background, and of the training rows."""
    rows, model = _stump(spark, sf)
    leaves = explain.read_leaves(explain.leaf_table(spark, model))
    background = explain.background_matrix(rows, "key", "vector")
    values = [(explain.interventional_base(leaves, background), explain.path_base(leaves))]
    return rounded(spark.createDataFrame(values, "background double, path double"))


def preprocess_complete(spark, sf):
    """Without gaps the chains change nothing: clipped numbers, then codes, as one vector."""
    df = checkpointed(table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"))
    fitted = build_preprocessor(df.columns[:2], df.columns[2:]).fit(df)
    x = vector_to_array("features")
    return rounded(fitted.transform(df).select(*[F.get(x, F.lit(i)).alias(f"x{i}") for i in range(4)]))


def _complete_sql() -> str:
    clipped = ", ".join(
        f"round(least(greatest({c}, (select quantile_cont({c}, 0.01) from lineitem)),"
        f" (select quantile_cont({c}, 0.99) from lineitem)), 9) as x{i}"
        for i, c in enumerate(["l_quantity", "l_extendedprice"])
    )
    coded = ", ".join(
        f"cast((select count(distinct b.{c}) from lineitem b where b.{c} < k.{c}) as double) as x{i}"
        for i, c in ((2, "l_returnflag"), (3, "l_linestatus"))
    )
    return f"""with k as (select distinct l_returnflag, l_linestatus from lineitem), d as (select *, {coded} from k)
      select {clipped}, x2, x3 from lineitem join d using (l_returnflag, l_linestatus)"""


def train_score(spark, sf):
    """Fit on train, choose the threshold on valid, refit on both, score the test rows."""
    rows = checkpointed(documents(spark, sf, gaps=True).drop("poor"))
    split = checkpointed(stratified_split(rows, "toxic", "key", 0.2, 0.15, 42))
    train, valid, test = (split.where(F.col("split") == p).drop("split") for p in ("train", "valid", "test"))
    estimator = boosting.RiskEstimator(_spec(strategy="borderline_smote"))
    held = boosting.score(estimator.fit(train), valid, "key", "toxic")
    cut = float(select_threshold(checkpointed(held), "maximize_f2").first()["threshold"])
    model = estimator.fit(train_and_valid(split).drop("split"))
    scored = boosting.score(model, test, "key", "toxic").withColumn("threshold", F.lit(cut))
    return rounded(scored.withColumn("label", (F.col("p") >= F.lit(cut)).cast("int")))


def baseline_cv(spark, sf):
    rows = checkpointed(documents(spark, sf).drop("toxic"))
    return rounded(search.baseline_cv(rows, _spec("poor", "borderline_smote"), 2, 0.2, parallelism=2))


def random_search(spark, sf):
    rows = checkpointed(documents(spark, sf).drop("poor"))
    limits = {"n_estimators": 3, "max_depth": 3, "reg_alpha": 0.0, "reg_lambda": 1.0}
    found = search.random_search(rows, _spec(strategy="borderline_smote_ncr"), 2, 2, "pr_auc", limits=limits, parallelism=2)
    return rounded(found.trials.select("trial", "value", "state", "sampler.*"))


def baseline_cv_cells(spark, sf):
    """Rows and positives that each fold was measured on."""
    rows = checkpointed(documents(spark, sf).drop("toxic"))
    folds = search.baseline_cv(rows, _spec("poor"), 5, 0.2, parallelism=2)
    return folds.select(
        "fold",
        (F.col("tp") + F.col("fn")).cast("long").alias("positives"),
        (F.col("tn") + F.col("fp")).cast("long").alias("negatives"),
    )


BASELINE_CELLS = """with s as (select doc_id as key, 1 - quality as y from documents join labels using (doc_id)),
 r as (select *, row_number() over (partition by y order by md5(concat(cast(key as varchar), '|42')), key) as rn,
   count(*) over (partition by y) as n from s),
 f as (select y, cast(1 + (rn > ceil(n * 1 / 5.0::double))::int + (rn > ceil(n * 2 / 5.0::double))::int
   + (rn > ceil(n * 3 / 5.0::double))::int + (rn > ceil(n * 4 / 5.0::double))::int as int) as fold from r)
select fold, count(*) filter (y = 1) as positives, count(*) filter (y = 0) as negatives from f group by fold"""


def _fitted(spark, sf):
    rows = documents(spark, sf).drop("poor")
    model = boosting.RiskEstimator(_spec()).fit(checkpointed(rows))
    return rows, model


def leaf_table(spark, sf):
    _, model = _fitted(spark, sf)
    leaves = explain.leaf_table(spark, model.stages[1])
    return rounded(leaves.select("tree", "leaf", "value", "cover", F.size("path").alias("path_features")))


def shap_model(spark, sf):
    """Values of a fitted model against a background sample, with the margin they add up to."""
    rows, model = _fitted(spark, sf)
    prepare, trees = model.stages
    leaves = explain.read_leaves(explain.leaf_table(spark, trees))
    ready = trees.transform(prepare.transform(rows)).select(
        "key",
        vector_to_array("features").alias("x"),
        F.get(vector_to_array("rawPrediction"), F.lit(1)).alias("margin"),
    )
    background = explain.background_matrix(ready, "key", "x")
    base = explain.interventional_base(leaves, background)
    explained = ready.withColumn("shap", explain.shap_values(F.col("x"), leaves, background))
    total = F.aggregate("shap", F.lit(0.0), lambda a, b: a + b)
    return rounded(explained.select("key", "margin", (total + F.lit(base)).alias("explained")))


def shap_model_gap(spark, sf):
    """How far contributions and base value are from the margin, per row."""
    return shap_model(spark, sf).select("key", F.round(F.abs(F.col("margin") - F.col("explained")), 6).alias("gap"))


def score_checks(spark, sf):
    """Label and tier of every scored record, held against its probability."""
    p = F.col("predicted_probability")
    fixed = tiers.fixed_probability_tiers(0.06)
    tier = F.lit(None).cast("string")
    for t in sorted(fixed, key=lambda t: t["min_prob"]):
        tier = F.when(p >= t["min_prob"], t["name"]).otherwise(tier)
    return score(spark, sf).select(
        "key",
        F.col("predicted_label").eqNullSafe((p >= 0.3).cast("int")).alias("label_right"),
        F.col("risk_tier").eqNullSafe(tier).alias("tier_right"),
        F.size("explanation").alias("reasons"),
    )


def score(spark, sf):
    rows, model = _fitted(spark, sf)
    leaves = explain.read_leaves(explain.leaf_table(spark, model.stages[1]))
    tier_list = tiers.fixed_probability_tiers(0.06)
    return score_records(rows.drop("toxic"), model, leaves, 0.3, tier_list, run_id="run_0")


# ---------------------------------------------------------------- Shapley values on given leaves

# A small ensemble over (value, user, hour): tree, leaf, value, cover, path of
# (feature, low, high, cover ratio).
INF = math.inf
LEAVES = [
    (0, 2, -0.6, 30.0, [(0, -INF, 40.0, 0.6), (1, -INF, 70.0, 0.5)]),
    (0, 3, 0.1, 30.0, [(0, -INF, 40.0, 0.6), (1, 70.0, INF, 0.5)]),
    (0, 4, 0.5, 40.0, [(0, 40.0, INF, 0.4)]),
    (1, 2, -0.2, 35.0, [(1, -INF, 100.0, 0.7), (2, -INF, 11.0, 0.5)]),
    (1, 3, 0.3, 35.0, [(1, -INF, 100.0, 0.7), (2, 11.0, INF, 0.5)]),
    (1, 4, 0.45, 30.0, [(1, 100.0, INF, 0.3)]),
    (2, 1, -0.3, 50.0, [(0, -INF, 25.0, 0.5)]),
    (2, 3, 0.15, 30.0, [(0, 25.0, 80.0, 0.4), (2, -INF, 17.0, 0.75)]),
    (2, 4, 0.6, 7.5, [(0, 80.0, INF, 0.1), (2, -INF, 17.0, 0.75)]),
    (2, 5, 0.35, 5.0, [(0, 25.0, INF, 0.5), (1, -INF, 50.0, 0.4), (2, 17.0, INF, 0.25)]),
    (2, 6, -0.1, 7.5, [(0, 25.0, INF, 0.5), (1, 50.0, INF, 0.6), (2, 17.0, INF, 0.25)]),
]
FEATURES = ["value", "user", "hour"]


def _rows(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_id").alias("key"),
        F.array(
            F.col("value"), F.col("user_id").cast("double"), (F.col("event_id") % 24).cast("double")
        ).alias("x"),
        (F.col("value") / (F.col("value") + 100.0)).alias("p"),
    )


def _explained(spark, sf, against_background: bool):
    leaves = explain.read_leaves(spark.createDataFrame(LEAVES, explain.LEAF_SCHEMA))
    rows = _rows(spark, sf)
    background = explain.background_matrix(rows, "key", "x") if against_background else None
    return rows.withColumn("shap", explain.shap_values(F.col("x"), leaves, background))


def _long(spark, sf, against_background: bool = True):
    return explain.shap_long(_explained(spark, sf, against_background), FEATURES)


def _leaf_sql() -> str:
    """Leaves with one interval and ratio per feature; an absent feature is always satisfied."""

    def number(v: float) -> str:
        return f"'{'-' if v < 0 else ''}infinity'::double" if math.isinf(v) else f"{v}::double"

    rows = []
    for tree, leaf, value, _, path in LEAVES:
        by = {f: (lo, hi, r) for f, lo, hi, r in path}
        cells = ", ".join(
            f"{number(lo)}, {number(hi)}, {r}::double" for lo, hi, r in (by.get(f, (-INF, INF, 1.0)) for f in range(3))
        )
        rows.append(f"({tree}, {leaf}, {value}::double, {cells})")
    columns = ", ".join(f"lo{f}, hi{f}, r{f}" for f in range(3))
    return f"lf as (select * from (values {', '.join(rows)}) t(tree, leaf, v, {columns}))"


EVENTS = """e as (select event_id as key, value as x0, cast(user_id as double) as x1, cast(event_id % 24 as double) as x2,
  value / (value + 100.0) as p from events)"""
INSIDE = ", ".join(f"x{f} > lo{f} and x{f} <= hi{f} as in{f}" for f in range(3))
MASKS = f"xm as (select key, tree, leaf, v, r0, r1, r2, {INSIDE} from e, lf)"


def _interventional_sql() -> str:
    both_out = " or ".join(f"(not xm.in{f} and not zm.in{f})" for f in range(3))
    only_x = " + ".join(f"(xm.in{f} and not zm.in{f})::int" for f in range(3))
    only_z = " + ".join(f"(zm.in{f} and not xm.in{f})::int" for f in range(3))
    phi = ", ".join(
        f"""sum(case when in{f} and not zin{f} then v * w * factorial(a - 1) * factorial(b) / factorial(a + b)
           when zin{f} and not in{f} then -v * w * factorial(a) * factorial(b - 1) / factorial(a + b) else 0 end) as s{f}"""
        for f in range(3)
    )
    return f"""with {EVENTS}, {_leaf_sql()}, bg as (select * from e order by md5(concat(cast(key as varchar), '|42')), key limit 300),
 zm as (select tree, leaf, in0, in1, in2, count(*) / cast((select count(*) from bg) as double) as w
   from (select tree, leaf, {INSIDE} from bg, lf) group by tree, leaf, in0, in1, in2), {MASKS},
 pr as (select xm.*, zm.in0 as zin0, zm.in1 as zin1, zm.in2 as zin2, w, {only_x} as a, {only_z} as b
   from xm join zm using (tree, leaf) where not ({both_out})),
 ph as (select key, {phi} from pr group by key)"""


def _path_sql() -> str:
    def phi(i: int, j: int, k: int) -> str:
        o = [f"in{f}::int" for f in range(3)]
        z = [f"r{f}" for f in range(3)]
        weight = (
            f"{z[j]} * {z[k]} / 3 + {o[j]} * {z[k]} / 6 + {z[j]} * {o[k]} / 6 + {o[j]} * {o[k]} / 3.0::double"
        )
        return f"sum(v * ({o[i]} - {z[i]}) * ({weight})) as s{i}"

    sums = ", ".join([phi(0, 1, 2), phi(1, 0, 2), phi(2, 0, 1)])
    return f"with {EVENTS}, {_leaf_sql()}, {MASKS}, ph as (select key, {sums} from xm group by key)"


def _long_sql(head: str) -> str:
    parts = " union all ".join(
        f"select e.key, '{n}' as feature, x{f} as feature_value, s{f} as shap_value from ph join e using (key)"
        for f, n in enumerate(FEATURES)
    )
    return f"{head}, lg as ({parts})"


ROUND = "round(feature_value, 9) as feature_value, round(shap_value, 9) as shap_value"
INTERVENTIONAL = _long_sql(_interventional_sql())


def shap_topk(spark, sf):
    explained = _explained(spark, sf, True)
    # Rounded first, so that equal magnitudes are equal on both sides.
    shap = F.transform("shap", lambda s: F.round(s, 9))
    best = explain.top_contributions(FEATURES, F.col("x"), shap, 2)
    return explained.select("key", F.posexplode(best).alias("_at", "_c")).select(
        "key", (F.col("_at") + 1).alias("rank"), "_c.feature", "_c.feature_value", "_c.shap_value"
    )


def shap_top_local(spark, sf):
    explained = _explained(spark, sf, True).withColumn("shap", F.transform("shap", lambda s: F.round(s, 9)))
    return rounded(explain.most_at_risk(explained, FEATURES))


QUERIES = {
    "gbt_fit_score": (gbt_fit_score, None),
    "train_score": (train_score, None),
    "baseline_cv": (baseline_cv, None),
    "random_search": (random_search, None),
    "leaf_table": (leaf_table, None),
    "shap_model": (shap_model, None),
    "score_records": (score, None),
    "gbt_stump_score": (
        gbt_stump_score,
        f"""{STUMP_SQL} select key, y, round(1 / (1 + exp(-2 * (case when h <= cut then sl / wl else sr / wr end))), 9) as p
          from e, t""",
    ),
    "leaf_table_stump": (
        leaf_table_stump,
        f"""{STUMP_SQL} select cast(0 as int) as tree, cast(1 as int) as leaf, round(sl / wl, 9) as value, wl as cover,
          round(wl / (wl + wr), 9) as ratio, cut + 0.5::double as cut from t
          union all select 0, 2, round(sr / wr, 9), wr, round(wr / (wl + wr), 9), cut + 0.5::double from t""",
    ),
    "shap_stump_base": (
        shap_stump_base,
        f"""{STUMP_SQL}, bg as (select * from e order by md5(concat(cast(key as varchar), '|42')), key limit 300)
          select round(avg(case when h <= cut then sl / wl else sr / wr end), 9) as background,
          round(any_value((sl + sr) / (wl + wr)), 9) as path from bg, t""",
    ),
    "preprocess_complete": (preprocess_complete, _complete_sql()),
    "baseline_cv_cells": (baseline_cv_cells, BASELINE_CELLS),
    "shap_model_gap": (
        shap_model_gap,
        "select doc_id as key, 0.0::double as gap from documents join labels using (doc_id)",
    ),
    "score_checks": (
        score_checks,
        """select doc_id as key, true as label_right, true as tier_right, cast(5 as int) as reasons
          from documents join labels using (doc_id)""",
    ),
    "shap_interventional": (
        lambda spark, sf: rounded(_long(spark, sf)),
        f"{INTERVENTIONAL} select key, feature, {ROUND} from lg",
    ),
    "shap_path_dependent": (
        lambda spark, sf: rounded(_long(spark, sf, False)),
        f"{_long_sql(_path_sql())} select key, feature, {ROUND} from lg",
    ),
    "seeded_sample": (
        lambda spark, sf: explain.seeded_sample(table(spark, sf, "events").select("event_id", "value"), "event_id", 500, 42),
        "select event_id, value from events order by md5(concat(cast(event_id as varchar), '|42')), event_id limit 500",
    ),
    "shap_importance": (
        lambda spark, sf: rounded(explain.shap_importance(_long(spark, sf))),
        f"""{INTERVENTIONAL} select feature, round(avg(abs(shap_value)), 9) as mean_abs_shap,
          round(min(shap_value), 9) as min_shap, round(max(shap_value), 9) as max_shap from lg group by feature""",
    ),
    "shap_distribution": (
        lambda spark, sf: rounded(explain.shap_distribution(_explained(spark, sf, True), FEATURES), 6),
        f"""{INTERVENTIONAL} select feature, count(*) as n, round(avg(abs(shap_value)), 6) as mean_abs_shap,
          round(avg(shap_value), 6) as mean_shap,
          {", ".join(f"round(quantile_cont(shap_value, {q}), 6) as q{round(100 * q):02d}" for q in (0.05, 0.25, 0.5, 0.75, 0.95))},
          case when stddev_pop(feature_value) * stddev_pop(shap_value) > 0
            then round(corr(feature_value, shap_value), 6) end as direction from lg group by feature""",
    ),
    "shap_top_local": (
        shap_top_local,
        f"""{INTERVENTIONAL}, top as (select key, p from e order by p desc, key limit 1),
          rk as (select key, p, feature, feature_value, round(shap_value, 9) as shap_value from lg join top using (key))
          select key, round(p, 9) as p, cast(row_number() over (order by abs(shap_value) desc, feature) as int) as rank,
          feature, feature_value, shap_value from rk""",
    ),
    "shap_topk": (
        shap_topk,
        f"""{INTERVENTIONAL}, rk as (select key, feature, feature_value, round(shap_value, 9) as shap_value from lg),
          rr as (select key, cast(row_number() over (partition by key order by abs(shap_value) desc, feature) as int) as rank,
          feature, feature_value, shap_value from rk) select * from rr where rank <= 2""",
    ),
}

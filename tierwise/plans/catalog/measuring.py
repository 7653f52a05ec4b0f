"""Metrics, thresholds, tiers and run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierwise.functions.fixed_values import ALLKNN_SEARCH_SPACE, NCR_SEARCH_SPACE, TIER_TABLE, TREE_SEARCH_SPACE
from tierwise.operators import metrics as M, run_reports as R, search, split, thresholds, tiers
from tierwise.operators.boosting import by_score, calibrate_isotonic, calibrate_sigmoid
from tierwise.operators.isotonic import isotonic_blocks
from tierwise.plans.catalog.bindings import (
    SCORED,
    SCORED_RUNS,
    SCORED_STEPS,
    SCORED_TIES,
    rounded,
    scored,
    scored_by_user,
    scored_steps,
    scored_ties,
)

CUT = 0.2
TOP = 0.55


def _safe(part: str, whole: str) -> str:
    return f"coalesce(cast({part} as double) / nullif({whole}, 0), 0.0)"


def _beta(b2: int, p: str = "precision", r: str = "recall") -> str:
    return f"coalesce({1 + b2}.0 * {p} * {r} / nullif({b2}.0 * {p} + {r}, 0), 0.0)"


def _counts(cut: float, by: str = "") -> str:
    """One row per group: confusion cells, size and positives, counted row by row."""
    return f"""k as (select {by + ',' if by else ''} count(*) filter (p < {cut} and y = 0) as tn,
  count(*) filter (p >= {cut} and y = 0) as fp, count(*) filter (p < {cut} and y = 1) as fn,
  count(*) filter (p >= {cut} and y = 1) as tp from s {'group by ' + by if by else ''})"""


def _rates(by: str = "") -> str:
    key = by + "," if by else ""
    return f"""m as (select {key} tn, fp, fn, tp, {_safe('tp', 'tp + fp')} as precision, {_safe('tp', 'tp + fn')} as recall,
  {_safe('tn', 'tn + fp')} as specificity from k)"""


def _curve(by: str = "") -> str:
    """Average precision by running sums, ROC by ranks."""
    key, part = (by + ",", f"partition by {by}") if by else ("", "")
    group = f"group by {by}" if by else ""
    return f"""g as (select {key} p, sum(y) as tp, count(*) as n from s group by {key} p),
 c as (select {key} tp, n, sum(tp) over ({part} order by p desc) as ctp, sum(n) over ({part} order by p desc) as cn,
   sum(tp) over ({part}) as pos from g),
 ap as (select {key} sum(cast(tp as double) / pos * ctp / cn) as pr_auc from c {group}),
 rk as (select {key} y, rank() over ({part} order by p) + (count(*) over (partition by {key} p) - 1) / 2.0 as r from s),
 au as (select {key} (sum(r) filter (y = 1) - count(*) filter (y = 1) * (count(*) filter (y = 1) + 1) / 2.0)
   / nullif(cast(count(*) filter (y = 1) as double) * count(*) filter (y = 0), 0) as roc_auc from rk {group}),
 br as (select {key} avg(pow(p - y, 2)) as brier from s {group})"""


def _full(source: str, by: str = "", digits: int = 9) -> str:
    key = f"m.{by}, " if by else ""
    using = f"using ({by})" if by else ""
    join = "join" if by else "cross join"
    return f"""with {source}, {_counts(CUT, by)}, {_rates(by)}, {_curve(by)},
 f as (select {key} {CUT}::double as threshold, round(pr_auc, {digits}) as pr_auc, round(roc_auc, {digits}) as roc_auc,
  round(recall, {digits}) as recall, round(precision, {digits}) as precision, round({_beta(1)}, {digits}) as f1,
  round({_beta(4)}, {digits}) as f2, round(specificity, {digits}) as specificity, round(brier, {digits}) as brier,
  tn, fp, fn, tp from m {join} ap {using} {join} au {using} {join} br {using})"""


def _top(source: str) -> str:
    return f"""with {source}, o as (select y, row_number() over (order by p desc,
   md5(concat(cast(key as varchar), '|0')), key) as rn, count(*) over () as n, sum(y) over () as pos from s),
 {_curve()}, h as (select max(greatest(1, ceil(n * {TOP}::double))) as k, max(pos) as pos,
   sum(y) filter (rn <= greatest(1, ceil(n * {TOP}::double))) as got from o)"""


# ---------------------------------------------------------------- thresholds

GRID = f"""t as (select i, case when i = 199 then 0.99 else 0.001::double + i * ((0.99::double - 0.001::double) / 199) end as threshold
   from (select unnest(range(200)) as i)),
 q as (select threshold, count(*) filter (p >= threshold and y = 1) as tp, count(*) filter (p >= threshold) as flagged,
   count(*) filter (y = 1) as pos from t, s group by threshold),
 e as (select threshold, {_safe('tp', 'flagged')} as precision, {_safe('tp', 'pos')} as recall from q),
 g as (select threshold, precision, recall, {_beta(1)} as f1, {_beta(4)} as f2 from e)"""
GRID_COLUMNS = (
    "round(threshold, 9) as threshold, round(precision, 9) as precision, round(recall, 9) as recall, "
    "round(f1, 9) as f1, round(f2, 9) as f2"
)


def _choice(name: str, order: str, where: str = "", margin: float = 1.0, cap: float | None = None) -> str:
    return f"""with {SCORED}, {GRID} select '{name}' as strategy, 0.2::double as min_precision,
 {margin}::double as safety_margin, cast({cap if cap is not None else 'null'} as double) as max_threshold,
 {GRID_COLUMNS} from g {where} order by {order} limit 1"""


def _select(name: str, **kw):
    return lambda spark, sf: rounded(
        thresholds.select_threshold(scored(spark, sf), name, min_precision=0.2, **kw)
    )


MARGIN, CAP = 0.3, 0.5
BELOW = f"""where g.threshold <= greatest(coalesce(least((select min(p) from s where y = 1) * {MARGIN}::double, {CAP}::double),
  0.001::double), 0.001::double)"""
RECALL_100 = _choice("recall_100", "threshold desc", BELOW, MARGIN, CAP)
FEASIBLE = """case when precision >= 0.2 then 0 else 1 end, case when precision >= 0.2 then recall else f2 end desc,
 case when precision >= 0.2 then f2 else recall end desc, case when precision >= 0.2 then 0 else precision end desc, threshold"""


# ---------------------------------------------------------------- tiers

TIERS = tiers.fixed_probability_tiers(0.01)


def _texts(field: str) -> str:
    cases = " ".join(f"when '{t['label']}' then '{t[field]}'" for t in TIER_TABLE)
    return f"case risk_label {cases} end"


LABELLED = """l as (select *, case when p >= 0.30 then 'critical' when p >= 0.15 then 'high'
   when p >= 0.05 then 'moderate' else 'low' end as risk_label from s)"""
PRIORITY = "case risk_label when 'critical' then 1 when 'high' then 2 when 'moderate' then 3 else 4 end"
MIN_PROB = "case risk_label when 'critical' then 0.30 when 'high' then 0.15 when 'moderate' then 0.05 else 0.01 end"


def risk_tiers(spark, sf):
    """Tiers around the gate chosen on the scored rows, with the rows at or above each cut."""
    rows = scored(spark, sf)
    chosen = thresholds.select_threshold(rows, "recall_100", safety_margin=MARGIN, max_threshold=CAP)
    tier_list = tiers.fixed_probability_tiers(chosen.first()["threshold"])
    at_least = rows.agg(
        *[F.count_if(F.col("p") >= F.lit(t["min_prob"])).alias(t["label"]) for t in tier_list]
    )
    cells = [
        F.struct(
            F.lit(t["label"]).alias("label"),
            F.lit(t["name"]).alias("name"),
            F.lit(t["name_en"]).alias("name_en"),
            F.lit(t["color"]).alias("color"),
            F.lit(t["priority"]).alias("priority"),
            F.lit(t["min_prob"]).alias("min_prob"),
            F.col(t["label"]).alias("rows_at_or_above"),
        )
        for t in tier_list
    ]
    return rounded(at_least.select(F.explode(F.array(*cells)).alias("t")).select("t.*"))


def _risk_tiers_sql() -> str:
    cut = f"(select threshold from g {BELOW} order by threshold desc limit 1)"
    cuts = {"critical": "0.30", "high": "0.15", "moderate": f"greatest(0.05, {cut} + 1e-6)", "low": cut}
    parts = [
        f"select '{t['label']}' as label, '{t['name']}' as name, '{t['name_en']}' as name_en, '{t['color']}' as color, "
        f"cast({t['priority']} as int) as priority, cast({cuts[t['label']]} as double) as min_prob"
        for t in TIER_TABLE
    ]
    return f"""with {SCORED}, {GRID}, w as ({' union all '.join(parts)})
 select label, name, name_en, color, priority, round(min_prob, 9) as min_prob,
   (select count(*) from s where p >= min_prob) as rows_at_or_above from w"""


def _summary_sql(source: str, by: str = "") -> str:
    key = by + "," if by else ""
    groups = f"(select distinct {by} from s)," if by else ""
    labels = ", ".join(f"('{t['label']}')" for t in TIER_TABLE)
    match = f"l.risk_label = a.risk_label and l.{by} = a.{by}" if by else "l.risk_label = a.risk_label"
    a_key = f"a.{by}," if by else ""
    return f"""with {source}, {LABELLED}, a as (select * from {groups} (values {labels}) v(risk_label)),
 n as (select {a_key} a.risk_label, count(l.key) as count, count(*) filter (l.y = 1) as tp, count(*) filter (l.y = 0) as fp
   from a left join l on {match} group by {a_key} a.risk_label),
 ts as (select {key} risk_label, {_texts('name')} as name, cast({PRIORITY} as int) as priority,
   cast({MIN_PROB} as double) as min_prob, {_texts('followup')} as followup, {_texts('clinical_action')} as clinical_action,
   count, tp as true_positives, fp as false_positives, round({_safe('tp', 'count')}, 4) as precision,
   round({_safe('tp', 'count')} * 100.0, 1) as positive_rate_pct from n)"""


def _stratified(spark, sf):
    return tiers.stratify_risk(scored(spark, sf), TIERS, ["key", "y"])


# ---------------------------------------------------------------- runs


def _run_metrics(spark, sf):
    return M.classification_metrics(scored_by_user(spark, sf), CUT, ["run_id"])


def _run_tiers(spark, sf):
    """Tier reports; run 3 has none."""
    rows = scored_by_user(spark, sf).where("run_id <> 'run_3'")
    strata = tiers.stratify_risk(rows, TIERS, ["key", "y", "run_id"])
    return tiers.tier_summary(strata, TIERS, ["run_id"])


def _run_summary(spark, sf):
    return R.run_summary(_run_metrics(spark, sf), _run_tiers(spark, sf))


def run_latest(spark, sf):
    records = scored_by_user(spark, sf).where("run_id <> 'run_3'").groupBy("run_id").agg(F.max("key").alias("created"))
    return rounded(R.run_latest(_run_summary(spark, sf), records))


def _tier_part() -> str:
    return _summary_sql(SCORED_RUNS, "run_id").split(SCORED_RUNS, 1)[1].lstrip(", ")


def _runs_sql() -> str:
    full = _full(SCORED_RUNS, "run_id")
    sums = ", ".join(
        f"max(case when risk_label = '{t}' then count end) as {t}_n, max(case when risk_label = '{t}' then true_positives end) as {t}_tp"
        for t in R.TIERS
    )
    # Names of the tier part are kept apart from those of the metric part.
    tier = _tier_part().replace(" l as (", " ll as (").replace("left join l on", "left join ll l on")
    tier = ("," + tier).replace(",l as (", ",ll as (").lstrip(",")
    top_n, top_tp = "(critical_n + high_n + moderate_n)", "(critical_tp + high_tp + moderate_tp)"
    return f"""{full}, {tier}, pv as (select run_id, {sums} from ts where run_id <> 'run_3' group by run_id),
 rs as (select f.run_id, threshold, pr_auc, roc_auc, recall, precision, specificity, brier,
   critical_n, high_n, moderate_n, low_n, critical_tp, high_tp, moderate_tp, low_tp,
   {top_n} as top_n, {top_tp} as top_tp, round({_safe(top_n, top_n + ' + low_n')}, 9) as top_rate,
   round({_safe(top_tp, top_tp + ' + low_tp')}, 9) as top_recall, tn, fp, fn, tp from f join pv using (run_id))"""


def _shares() -> str:
    parts = [
        f"select run_id, '{c}' as cell, {c} as count, round({_safe(c, 'tn + fp + fn + tp')} * 100.0, 1) as share_pct from k"
        for c in R.CELLS
    ]
    return f"with {SCORED_RUNS}, {_counts(CUT, 'run_id')} " + " union all ".join(parts)


# ---------------------------------------------------------------- folds, trials


def _fold_scores(spark, sf):
    """Precision of every trial at every step, from folds of the scored rows."""
    folds = split.stratified_folds(scored_by_user(spark, sf), "y", "key", 5, 42)
    rows = folds.select("key", "y", "p", (F.col("user_id") % 20).alias("trial"), (F.col("fold") + 1).alias("step"))
    found = M.threshold_metrics(rows, 0.4, ["trial", "step"])
    return found.select("trial", "step", F.round("precision", 9).alias("score"))


def median_prune(spark, sf):
    means = search.running_means(_fold_scores(spark, sf)).drop("score")
    return rounded(search.median_prune(means.withColumn("running_mean", F.round("running_mean", 9))))


def best_trial(spark, sf):
    """Trials complete unless pruned; the best by its mean over all steps."""
    means = search.running_means(_fold_scores(spark, sf)).drop("score")
    judged = search.median_prune(means.withColumn("running_mean", F.round("running_mean", 9)))
    results = judged.groupBy("trial").agg(
        F.max_by("running_mean", "step").alias("value"),
        F.when(F.bool_or("prune"), "pruned").otherwise("complete").alias("state"),
    )
    return rounded(search.best_trial(results))


FOLDS = """r as (select *, row_number() over (partition by y order by md5(concat(cast(key as varchar), '|42')), key) as rn,
   count(*) over (partition by y) as n from s),
 fd as (select *, cast(1 + (rn > ceil(n * 1 / 5.0::double))::int + (rn > ceil(n * 2 / 5.0::double))::int
   + (rn > ceil(n * 3 / 5.0::double))::int + (rn > ceil(n * 4 / 5.0::double))::int as int) as step from r)"""
STEPS = f"""with {SCORED}, {FOLDS}, fs as (select user_id % 20 as trial, step,
   round({_safe('count(*) filter (p >= 0.4 and y = 1)', 'count(*) filter (p >= 0.4)')}, 9) as score from fd group by 1, 2),
 rm as (select trial, step, round(avg(score) over (partition by trial order by step), 9) as running_mean from fs),
 mp as (select a.trial, a.step, a.running_mean, median(b.running_mean) as median_before, count(b.trial) as seen
   from rm a left join rm b on a.step = b.step and b.trial < a.trial group by a.trial, a.step, a.running_mean),
 pr as (select trial, step, running_mean, round(median_before, 9) as median_before,
   coalesce(step > 2 and seen >= 5 and running_mean < median_before, false) as prune from mp)"""
BEST = f"""{STEPS}, dn as (select trial, max_by(running_mean, step) as value, bool_or(prune) as cut from pr group by trial),
 tp as (select trial, value from dn where not cut order by value desc, trial limit 1)
select (select trial from tp) as best_trial, (select round(value, 9) from tp) as best_value, (select count(*) from dn) as n_trials"""


def cv_summary(spark, sf):
    rows = split.stratified_folds(scored(spark, sf), "y", "key", 5, 42)
    return rounded(search.cv_summary(M.classification_metrics(rows, CUT, ["fold"])))


def _cv_sql() -> str:
    source = f"{SCORED.replace('s as', 's0 as')}, {FOLDS.replace('from s)', 'from s0)')}, s as (select key, y, p, step as fold from fd)"
    full = _full(source, "fold", 15)
    parts = [
        f"select '{m}' as metric, round(avg({m}), 9) as mean, round(stddev_pop({m}), 9) as std from f"
        for m in search.CV_METRICS
    ]
    return full + " " + " union all ".join(parts)


def _draw(name: str, kind: str, low, high) -> str:
    u = f"(('0x' || substr(md5(concat(cast(trial as varchar), '|42|{name}')), 1, 8))::bigint / 4294967296.0::double)"
    if kind == "choice":
        return f"case when {u} < 0.5 then '{low}' else '{high}' end as {name}"
    if kind == "int":
        return f"cast({low} + floor({u} * {high - low + 1}) as int) as {name}"
    if kind == "log":
        return f"round(exp(ln({low}::double) + {u} * (ln({high}::double) - ln({low}::double))), 9) as {name}"
    return f"round({low}::double + {u} * ({high}::double - {low}::double), 9) as {name}"


def search_trials(spark, sf):
    """One trial per user of the event table."""
    users = scored_by_user(spark, sf).select(F.col("user_id").alias("trial")).distinct()
    trials = search.search_trials(users, "borderline_smote_allknn", 42)
    return rounded(trials.select("trial", "model.*", "sampler.*"))


def search_trials_ncr(spark, sf):
    """The other cleaner's settings, with the number of trees held at 200."""
    users = scored_by_user(spark, sf).select(F.col("user_id").alias("trial")).distinct()
    trials = search.search_trials(users, "borderline_smote_ncr", 42, limits={"n_estimators": 200})
    return rounded(trials.select("trial", "model.*", "sampler.*"))


def _trials_sql(sampler: list[tuple]) -> str:
    draws = ", ".join(_draw(*row) for row in [*TREE_SEARCH_SPACE, *sampler])
    return f"with x as (select distinct user_id as trial from events) select trial, {draws} from x"


def _isotonic_sql(rows: str) -> str:
    """Value of each distinct score: the greatest over starts of the least mean over ends."""
    return f"""with {rows}, g as (select p, sum(y) as pos, count(*) as n from s group by p),
 o as (select p, row_number() over (order by p) as i, sum(pos) over (order by p) as cp, sum(n) over (order by p) as cn from g),
 z as (select * from o union all select null, 0, 0, 0),
 b as (select k.i as i, k.p as p, lo.i as lo, min((hi.cp - lo.cp) / cast(hi.cn - lo.cn as double)) as low_mean
   from o k join z lo on lo.i < k.i join o hi on hi.i >= k.i group by k.i, k.p, lo.i),
 c as (select p, max(low_mean) as calibrated from b group by i, p)"""


ISOTONIC = f"""{_isotonic_sql(SCORED_TIES)}
select s.key, s.y, round(s.p, 9) as p, round(c.calibrated, 9) as calibrated from s join c on s.p = c.p"""


def _sigmoid_sql(steps: int = 12) -> str:
    """Platt's fit by Newton steps over the distinct scores."""
    parts = [
        SCORED,
        "tg as (select (sum(y) + 1.0) / (sum(y) + 2.0) as hi, 1.0 / (count(*) - sum(y) + 2.0) as lo from s)",
        "g as materialized (select p, cast(count(*) as double) as n, "
        "cast(sum(case when y = 1 then hi else lo end) as double) as t from s, tg group by p)",
        "w0 as (select 0.0::double as a, 0.0::double as b)",
    ]
    for i in range(steps):
        parts.append(
            f"""h{i} as (select any_value(a) as a, any_value(b) as b, sum(n * q - t) as gb, sum((n * q - t) * p) as ga,
   sum(n * q * (1 - q)) as bb, sum(n * q * (1 - q) * p) as ab, sum(n * q * (1 - q) * p * p) as aa
   from (select g.*, a, b, 1 / (1 + exp(-(a * p + b))) as q from g, w{i})),
 w{i + 1} as materialized (select a - (bb * ga - ab * gb) / (aa * bb - ab * ab) as a,
   b - (aa * gb - ab * ga) / (aa * bb - ab * ab) as b from h{i})"""
        )
    return (
        f"with {', '.join(parts)} select key, y, round(p, 9) as p, "
        f"round(1 / (1 + exp(-(a * p + b))), 4) as calibrated from s, w{steps}"
    )


QUERIES = {
    "confusion_matrix": (
        lambda spark, sf: M.confusion_matrix(scored(spark, sf), CUT),
        f"with {SCORED}, {_counts(CUT)} select tn, fp, fn, tp from k",
    ),
    "threshold_metrics": (
        lambda spark, sf: rounded(M.threshold_metrics(scored(spark, sf), CUT)),
        f"""with {SCORED}, {_counts(CUT)}, {_rates()} select round(recall, 9) as recall, round(precision, 9) as precision,
          round({_beta(1)}, 9) as f1, round({_beta(4)}, 9) as f2, round(specificity, 9) as specificity from m""",
    ),
    "average_precision": (
        lambda spark, sf: rounded(M.average_precision(scored(spark, sf))),
        f"with {SCORED}, {_curve()} select round(pr_auc, 9) as pr_auc from ap",
    ),
    "average_precision_ties": (
        lambda spark, sf: rounded(M.average_precision(scored_ties(spark, sf))),
        f"with {SCORED_TIES}, {_curve()} select round(pr_auc, 9) as pr_auc from ap",
    ),
    "roc_auc": (
        lambda spark, sf: rounded(M.roc_auc(scored(spark, sf))),
        f"with {SCORED}, {_curve()} select round(roc_auc, 9) as roc_auc from au",
    ),
    "roc_auc_ties": (
        lambda spark, sf: rounded(M.roc_auc(scored_ties(spark, sf))),
        f"with {SCORED_TIES}, {_curve()} select round(roc_auc, 9) as roc_auc from au",
    ),
    "brier_score": (
        lambda spark, sf: rounded(M.brier_score(scored(spark, sf))),
        f"with {SCORED} select round(avg(pow(p - y, 2)), 9) as brier from s",
    ),
    "recall_at_top_pct": (
        lambda spark, sf: rounded(M.recall_at_top_pct(scored(spark, sf), TOP)),
        f"{_top(SCORED)} select round({_safe('got', 'pos')}, 9) as recall_at_top from h",
    ),
    "recall_at_top_pct_ties": (
        lambda spark, sf: rounded(M.recall_at_top_pct(scored_ties(spark, sf), TOP)),
        f"{_top(SCORED_TIES)} select round({_safe('got', 'pos')}, 9) as recall_at_top from h",
    ),
    "precision_at_top_pct": (
        lambda spark, sf: rounded(M.precision_at_top_pct(scored(spark, sf), TOP)),
        f"{_top(SCORED)} select round({_safe('got', 'k')}, 9) as precision_at_top from h",
    ),
    "tiering_score": (
        lambda spark, sf: rounded(M.tiering_score(scored(spark, sf), TOP, 0.4)),
        f"""{_top(SCORED)} select round(0.4 * (select pr_auc from ap) + 0.6 * {_safe('got', 'pos')}, 9)
          as tiering_score from h""",
    ),
    "classification_metrics": (
        lambda spark, sf: rounded(M.classification_metrics(scored(spark, sf), CUT)),
        f"{_full(SCORED)} select * from f",
    ),
    "classification_metrics_by_run": (
        lambda spark, sf: rounded(_run_metrics(spark, sf)),
        f"{_full(SCORED_RUNS, 'run_id')} select * from f",
    ),
    "threshold_grid": (
        lambda spark, sf: rounded(thresholds.threshold_grid(scored(spark, sf))),
        f"with {SCORED}, {GRID} select {GRID_COLUMNS} from g",
    ),
    "threshold_maximize_f1": (
        _select("maximize_f1"),
        _choice("maximize_f1", "f1 desc, recall desc, precision desc, threshold"),
    ),
    "threshold_maximize_f2": (
        _select("maximize_f2"),
        _choice("maximize_f2", "f2 desc, recall desc, precision desc, threshold"),
    ),
    "threshold_maximize_recall": (
        _select("maximize_recall"),
        _choice("maximize_recall", "recall desc, precision desc, f1 desc, threshold"),
    ),
    "threshold_recall_100": (_select("recall_100", safety_margin=MARGIN, max_threshold=CAP), RECALL_100),
    "threshold_recall_at_min_precision": (
        _select("recall_at_min_precision"),
        _choice("recall_at_min_precision", FEASIBLE),
    ),
    "risk_tiers": (risk_tiers, _risk_tiers_sql()),
    "assign_tier": (
        lambda spark, sf: scored(spark, sf).select(
            "key", tiers.assign_tier(F.col("p"), TIERS).alias("risk_label")
        ),
        f"with {SCORED}, {LABELLED} select key, risk_label from l",
    ),
    "stratify_risk": (
        lambda spark, sf: tiers.stratify_sorted(tiers.stratify_risk(scored(spark, sf), TIERS)),
        f"""with {SCORED}, {LABELLED} select key, round(p, 6) as probability, risk_label, {_texts('name')} as risk_name,
          cast({PRIORITY} as int) as priority, {_texts('clinical_action')} as clinical_action,
          {_texts('followup')} as followup, {_texts('color')} as color from l""",
    ),
    "tier_summary": (
        lambda spark, sf: tiers.tier_summary(_stratified(spark, sf), TIERS),
        f"{_summary_sql(SCORED)} select * from ts",
    ),
    "tier_overall": (
        lambda spark, sf: rounded(tiers.tier_overall(_stratified(spark, sf), 0.05)).drop("note"),
        f"""with {SCORED}, o as (select count(*) as total_flagged, count(*) filter (y = 1) as total_positive_cases,
          count(*) filter (y = 1) as captured_by_tiers, 0.05::double as stage1_threshold,
          count(*) filter (round(p, 6) >= 0.05) as stage1_flagged,
          count(*) filter (round(p, 6) >= 0.05 and y = 1) as captured_by_stage1 from s)
          select *, round({_safe('captured_by_stage1', 'total_positive_cases')}, 4) as stage1_recall from o""",
    ),
    "calibrate_isotonic": (
        lambda spark, sf: rounded(calibrate_isotonic(scored_ties(spark, sf), scored_ties(spark, sf))),
        ISOTONIC,
    ),
    "isotonic_blocks": (
        # 64 score ranges pooled apart and merged in a tree, whatever the size.
        lambda spark, sf: rounded(isotonic_blocks(by_score(scored_steps(spark, sf)))),
        f"""{_isotonic_sql(SCORED_STEPS)} select round(min(p), 9) as low, round(max(p), 9) as high, round(any_value(calibrated), 9) as value,
          cast(sum(n) as double) as weight from (select c.p, c.calibrated, g.n from c join g using (p)) group by round(calibrated, 12)""",
    ),
    "calibrate_sigmoid": (
        lambda spark, sf: rounded(calibrate_sigmoid(scored(spark, sf), scored(spark, sf))).withColumn(
            "calibrated", F.round("calibrated", 4)
        ),
        _sigmoid_sql(),
    ),
    "cv_summary": (cv_summary, _cv_sql()),
    "search_trials": (search_trials, _trials_sql(ALLKNN_SEARCH_SPACE)),
    "search_trials_ncr": (
        search_trials_ncr,
        f"select * replace (cast(200 as int) as n_estimators) from ({_trials_sql(NCR_SEARCH_SPACE)})",
    ),
    "median_prune": (median_prune, f"{STEPS} select * from pr"),
    "best_trial": (best_trial, BEST),
    "run_collect": (
        lambda spark, sf: R.run_collect(_run_metrics(spark, sf), _run_tiers(spark, sf)),
        f"with {SCORED_RUNS} select distinct run_id from s where run_id <> 'run_3'",
    ),
    "run_summary": (
        lambda spark, sf: rounded(_run_summary(spark, sf)),
        f"{_runs_sql()} select * from rs",
    ),
    "run_tier_rates": (
        lambda spark, sf: R.run_tier_rates(_run_tiers(spark, sf)),
        f"""{_summary_sql(SCORED_RUNS, 'run_id')} select run_id, risk_label, count, true_positives,
          positive_rate_pct as rate_pct from ts where run_id <> 'run_3'""",
    ),
    "run_confusion_shares": (
        lambda spark, sf: R.run_confusion_shares(_run_metrics(spark, sf)),
        _shares(),
    ),
    "run_trend": (
        lambda spark, sf: rounded(R.run_trend(_run_summary(spark, sf)), 7),
        f"""{_runs_sql()} select run_id, cast(row_number() over (order by run_id) as int) as position,
          round(recall, 7) as recall, round(pr_auc, 7) as pr_auc, top_n, round(brier, 7) as brier,
          round(recall - lag(recall) over (order by run_id), 7) as recall_change,
          round(pr_auc - lag(pr_auc) over (order by run_id), 7) as pr_auc_change,
          top_n - lag(top_n) over (order by run_id) as top_n_change,
          round(brier - lag(brier) over (order by run_id), 7) as brier_change from rs""",
    ),
    "run_latest": (
        run_latest,
        f"""{_runs_sql()} select * from rs where run_id = (select run_id from s where run_id <> 'run_3'
          order by key desc limit 1)""",
    ),
}

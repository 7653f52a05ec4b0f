"""Ranking and confusion metrics over scored rows ``(key, y, p)``.

Metrics are read off the score curve: one row per distinct score with running counts.
Grouping by score first makes a score shared by many rows one row, and the running counts
are taken in two levels (totals of score bands, then inside each band), so no window ever
covers the whole table.  Every function takes ``by`` to answer per fold, run or segment.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwise.functions.lineage import checkpointed
from tierwise.functions.ranking import FEW_GROUPS, take_by_hash

BANDS = 2048
TIE_SEED = 0


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0 where whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def f_beta(precision: Column, recall: Column, beta: float) -> Column:
    b2 = beta * beta
    return ratio(F.lit(1.0 + b2) * precision * recall, F.lit(b2) * precision + recall)


def score_curve(scored: DataFrame, by: Sequence[str] = (), y: str = "y", p: str = "p") -> DataFrame:
    """One row per distinct score: ``n``/``tp`` at it, ``cn``/``ctp`` at or above it, group totals."""
    by = list(by)
    points = scored.groupBy(*by, F.col(p).cast("double").alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("bigint")).alias("tp")
    )
    banded = _banded(scored.select(F.col(p).cast("double").alias("p")), points)
    totals = banded.groupBy(*by, "_band").agg(F.sum("n").alias("_bn"), F.sum("tp").alias("_bt"))
    # At most BANDS + 1 rows per group.
    group = Window.partitionBy(*by)
    above = group.orderBy(F.desc("_band")).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *[F.col(c).alias(f"_g_{c}") for c in by],
        F.col("_band").alias("_g_band"),
        F.coalesce(F.sum("_bn").over(above), F.lit(0)).alias("_an"),
        F.coalesce(F.sum("_bt").over(above), F.lit(0)).alias("_at"),
        F.sum("_bn").over(group).alias("total"),
        F.sum("_bt").over(group).alias("positives"),
    )
    if not by:
        totals = F.broadcast(totals)
    same = [F.col(c).eqNullSafe(F.col(f"_g_{c}")) for c in by]
    joined = banded.join(totals, [F.col("_band") == F.col("_g_band"), *same])
    inside = (
        Window.partitionBy(*by, "_band")
        .orderBy(F.desc("p"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return joined.select(
        *by,
        "p",
        "n",
        "tp",
        (F.col("_an") + F.sum("n").over(inside)).alias("cn"),
        (F.col("_at") + F.sum("tp").over(inside)).alias("ctp"),
        "total",
        "positives",
    )


def _banded(scores: DataFrame, points: DataFrame) -> DataFrame:
    """Cut the scores into bands that hold near equal numbers of rows."""
    cuts = scores.approxQuantile("p", [i / BANDS for i in range(1, BANDS)], 0.25 / BANDS)
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) < 3:
        return points.withColumn("_band", F.lit(0.0))
    return Bucketizer(splits=splits, inputCol="p", outputCol="_band").transform(points)


# ---------------------------------------------------------------- metric expressions


def _confusion(threshold: float) -> dict[str, Column]:
    hit = F.col("p") >= F.lit(float(threshold))
    tp = F.coalesce(F.sum(F.when(hit, F.col("tp"))), F.lit(0))
    flagged = F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0))
    return {
        "tn": F.max("total") - F.max("positives") - flagged + tp,
        "fp": flagged - tp,
        "fn": F.max("positives") - tp,
        "tp": tp,
    }


def _at_threshold(threshold: float) -> dict[str, Column]:
    c = _confusion(threshold)
    precision = ratio(c["tp"], c["tp"] + c["fp"])
    recall = ratio(c["tp"], c["tp"] + c["fn"])
    return {
        "recall": recall,
        "precision": precision,
        "f1": f_beta(precision, recall, 1.0),
        "f2": f_beta(precision, recall, 2.0),
        "specificity": ratio(c["tn"], c["tn"] + c["fp"]),
    }


def _average_precision() -> Column:
    gained = F.col("tp") / F.nullif(F.col("positives"), F.lit(0))
    return F.coalesce(F.sum(gained * F.col("ctp") / F.col("cn")), F.lit(0.0))


def _roc_auc() -> Column:
    neg = (F.col("n") - F.col("tp")).cast("double")
    all_neg = F.col("total") - F.col("positives")
    neg_below = all_neg - (F.col("cn") - F.col("ctp"))
    wins = F.sum(F.col("tp") * (neg_below + neg / 2.0))
    return F.try_divide(wins, F.max(F.col("positives").cast("double") * all_neg))


def _brier() -> Column:
    loss = F.col("tp") * F.pow(1.0 - F.col("p"), 2) + (F.col("n") - F.col("tp")) * F.pow("p", 2)
    return F.sum(loss) / F.max("total")


def _summary(scored: DataFrame, by: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    curve = score_curve(scored, by)
    return curve.groupBy(*by).agg(*[c.alias(name) for name, c in columns.items()])


# ---------------------------------------------------------------- metrics


def confusion_matrix(scored: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp where a row is flagged when p >= threshold."""
    flag = F.col("p") >= F.lit(float(threshold))
    pos = F.col("y") == 1
    return scored.groupBy(*by).agg(
        F.count_if(~flag & ~pos).alias("tn"),
        F.count_if(flag & ~pos).alias("fp"),
        F.count_if(~flag & pos).alias("fn"),
        F.count_if(flag & pos).alias("tp"),
    )


def threshold_metrics(scored: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """Recall, precision, F1, F2 and specificity at one threshold."""
    counts = confusion_matrix(scored, threshold, by)
    precision = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    recall = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.select(
        *by,
        recall.alias("recall"),
        precision.alias("precision"),
        f_beta(precision, recall, 1.0).alias("f1"),
        f_beta(precision, recall, 2.0).alias("f2"),
        ratio(F.col("tn"), F.col("tn") + F.col("fp")).alias("specificity"),
    )


def average_precision(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum of recall gains times precision over the distinct scores, highest first."""
    return _summary(scored, by, {"pr_auc": _average_precision()})


def roc_auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Chance that a positive outscores a negative, ties half; null with one class only."""
    return _summary(scored, by, {"roc_auc": _roc_auc()})


def brier_score(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by).agg(F.avg(F.pow(F.col("p") - F.col("y"), 2)).alias("brier"))


def classification_metrics(scored: DataFrame, threshold: float, by: Sequence[str] = ()) -> DataFrame:
    """The full metric row from one pass over the score curve."""
    columns = {
        "threshold": F.lit(float(threshold)),
        "pr_auc": _average_precision(),
        "roc_auc": _roc_auc(),
        **_at_threshold(threshold),
        "brier": _brier(),
        **_confusion(threshold),
    }
    return _summary(scored, by, columns)


def top_capture(
    scored: DataFrame, top_pct: float, by: Sequence[str] = (), key: str = "key"
) -> DataFrame:
    """Positives among the k = max(1, ceil(n*top_pct)) highest scores of each group.

    Rows that share the score at the cut are taken in a fixed hash order of their keys.
    Returns ``by``, ``k``, ``captured``, ``positives`` and ``pr_auc``.
    """
    if not 0.0 < top_pct <= 1.0:
        raise ValueError("top_pct must lie in (0, 1]")
    by = list(by)
    curve = score_curve(scored, by)
    k = F.greatest(F.lit(1), F.ceil(F.col("total") * F.lit(float(top_pct))))
    at_cut = (F.col("cn") - F.col("n") < k) & (k <= F.col("cn"))
    # One row per group: what lies above the cut score and what is still needed from it.
    # Written, because the ties below are looked at more than once.
    cut = curve.groupBy(*by).agg(
        F.max(k).alias("k"),
        F.max("positives").alias("positives"),
        _average_precision().alias("pr_auc"),
        F.max(F.when(at_cut, F.col("p"))).alias("_cut"),
        F.max(F.when(at_cut, F.col("ctp") - F.col("tp"))).alias("_above"),
        F.max(F.when(at_cut, k - F.col("cn") + F.col("n"))).alias("_need"),
    )
    cut = checkpointed(cut)
    needs = cut.select(*[F.col(c).alias(f"_c_{c}") for c in by], F.col("_cut").alias("_c_p"), "_need")
    few = not by or cut.count() <= FEW_GROUPS
    if few:
        needs = F.broadcast(needs)
    same = [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in by]
    ties = scored.join(needs, [F.col("p").cast("double") == F.col("_c_p"), *same])
    taken = take_by_hash(ties, by, key, TIE_SEED, "_need", F.col("y").cast("bigint"), few)
    taken = taken.select(*[F.col(c).alias(f"_t_{c}") for c in by], "taken")
    if by:
        joined = cut.join(taken, [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in by], "left")
    else:
        one = F.lit(1)
        joined = cut.withColumn("_one", one).join(
            F.broadcast(taken.withColumn("_t_one", one)), F.col("_one") == F.col("_t_one"), "left"
        )
    return joined.select(
        *by,
        "k",
        (F.col("_above") + F.coalesce("taken", F.lit(0))).alias("captured"),
        "positives",
        "pr_auc",
    )


def recall_at_top_pct(
    scored: DataFrame, top_pct: float, by: Sequence[str] = (), key: str = "key"
) -> DataFrame:
    found = top_capture(scored, top_pct, by, key)
    return found.select(*by, ratio(F.col("captured"), F.col("positives")).alias("recall_at_top"))


def precision_at_top_pct(
    scored: DataFrame, top_pct: float, by: Sequence[str] = (), key: str = "key"
) -> DataFrame:
    found = top_capture(scored, top_pct, by, key)
    return found.select(*by, ratio(F.col("captured"), F.col("k")).alias("precision_at_top"))


def tiering_score(
    scored: DataFrame,
    top_pct: float,
    pr_auc_weight: float = 0.4,
    by: Sequence[str] = (),
    key: str = "key",
) -> DataFrame:
    """weight * average precision + (1 - weight) * recall in the top share."""
    w = min(1.0, max(0.0, float(pr_auc_weight)))
    found = top_capture(scored, top_pct, by, key)
    recall = ratio(F.col("captured"), F.col("positives"))
    score = F.lit(w) * F.col("pr_auc") + F.lit(1.0 - w) * recall
    return found.select(*by, score.alias("tiering_score"))


def objective_score(
    scored: DataFrame,
    objective: str,
    threshold: float = 0.5,
    top_pct: float = 0.5,
    pr_auc_weight: float = 0.4,
    by: Sequence[str] = (),
    key: str = "key",
) -> DataFrame:
    """The named objective as column ``score``."""
    at_threshold: Callable[[], DataFrame] = lambda: threshold_metrics(scored, threshold, by)
    choices: dict[str, tuple[Callable[[], DataFrame], str]] = {
        "pr_auc": (lambda: average_precision(scored, by), "pr_auc"),
        "roc_auc": (lambda: roc_auc(scored, by), "roc_auc"),
        "recall_at_top_pct": (lambda: recall_at_top_pct(scored, top_pct, by, key), "recall_at_top"),
        "precision_at_top_pct": (
            lambda: precision_at_top_pct(scored, top_pct, by, key),
            "precision_at_top",
        ),
        "tiering_score": (
            lambda: tiering_score(scored, top_pct, pr_auc_weight, by, key),
            "tiering_score",
        ),
        "recall": (at_threshold, "recall"),
        "f1": (at_threshold, "f1"),
        "f2": (at_threshold, "f2"),
    }
    name = objective.lower()
    if name not in choices:
        raise ValueError(f"unknown objective {objective!r}; use one of {sorted(choices)}")
    make, column = choices[name]
    return make().select(*by, F.col(column).alias("score"))

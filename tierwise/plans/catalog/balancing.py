"""Neighbour joins and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierwise.operators import lsh as L, neighbors as N, resampling as R
from tierwise.plans.catalog.bindings import VECTORS, rounded, vectors

# ---- brute force over all pairs, for comparison only


def _pairs(source: str, name: str = "pd") -> str:
    return f"""{name} as materialized (select a.key as i, b.key as j, a.label as il, b.label as jl,
   list_sum(list_transform(list_zip(a.vector, b.vector), lambda z: pow(z[1] - z[2], 2))) as d2
   from {source} a join {source} b on a.key <> b.key)"""


def _near(pairs: str, k: int, where: str = "true") -> str:
    return f"""(select * from (select *, row_number() over (partition by i order by d2, j) as rk from {pairs}
   where {where}) where rk <= {k})"""


def _votes(pairs: str, k: int, where: str = "true") -> str:
    return f"""(select i, any_value(il) as il, count(*) as votes, count(*) filter (jl <> il) as against
   from {_near(pairs, k, where)} group by i)"""


ZONES = f"""{VECTORS}, {_pairs('v')}, z as (select i as key, against as n_majority, votes as n_neighbors,
   case when against = votes then 'noise' when against * 2 >= votes then 'danger' else 'safe' end as zone
   from {_votes('pd', 10, 'il = 1')})"""


def _hex(*parts: str) -> str:
    text = " || '|' || ".join(parts)
    return f"('0x' || substr(md5({text}), 1, 8))::bigint"


def _draw(name: str) -> str:
    return _hex("cast(n as varchar)", "'42'", f"'{name}'")


SMOTE = f"""{ZONES}, q as (select key, row_number() over (order by md5(concat(cast(key as varchar), '|42')), key) as rank
   from z where zone = 'danger' and (select count(*) from v where label = 1) > 1),
 rn as (select i, j, rk - 1 as pos from {_near('pd', 5, 'il = 1 and jl = 1')}),
 cnt as (select count(*) filter (label = 0) - count(*) filter (label = 1) as need, max(key) as top from v),
 dr as (select n, {_draw('point')} % (select count(*) from q) + 1 as rank, {_draw('neighbor')} as pick,
   {_draw('gap')} / 4294967296.0::double as u from (select unnest(range((select need from cnt))) as n)),
 mk as (select (select top from cnt) + 1 + n as key, 1 as label, a.vector as x, b.vector as y, u
   from dr join q using (rank) join v a on a.key = q.key
   join (select i, count(*) as size from rn group by i) sz on sz.i = q.key
   join rn on rn.i = q.key and rn.pos = pick % size join v b on b.key = rn.j),
 w as materialized (select key, label, vector, false as synthetic from v union all
   select key, label, list_transform(list_zip(x, y), lambda z: z[1] + u * (z[2] - z[1])) as vector, true from mk)"""


def _shown(df):
    """Rows with their vectors folded into two numbers."""
    vector = F.col("vector").cast("array<double>")
    total = F.aggregate(vector, F.lit(0.0), lambda a, b: a + b)
    return rounded(df.withColumns({"first": F.get(vector, F.lit(0)), "total": total}).drop("vector"), 6)


SHOWN = "round(vector[1], 6) as first, round(list_sum(vector), 6) as total"


def _allknn(source: str, n: int, stop: bool) -> str:
    """Rounds written out; a round passes everything on once an earlier one has stopped."""
    parts, last = [f"a0 as (select key, label from {source})", "st0 as (select false as stopped)"], 0
    for k in range(1, n + 1):
        alive = f"i in (select key from a{last}) and j in (select key from a{last}) and il = 0"
        parts.append(
            f"a{k} as materialized (select * from a{last} where (select stopped from st{last}) or key not in "
            f"(select i from {_votes('pw', k, alive)} where against * 2 > votes))"
        )
        smaller = f"(select count(*) filter (label = 0) < count(*) filter (label = 1) from a{k})" if stop else "false"
        parts.append(f"st{k} as (select (select stopped from st{last}) or {smaller} as stopped)")
        last = k
    return ", ".join(parts)


def _ncr(k: int, gate: str) -> str:
    return f"""o as materialized (select i, il, against * 2 > votes as outvoted from {_votes('pw', k)}),
 rm as (select i as key from o where il = 0 and outvoted union
   select j from {_near('pw', k)} where jl = 0 and i in (select i from o where il = 1 and outvoted) and {gate})"""


TOMEK = """nn as materialized (select i, j, il, jl from (select *, row_number() over (partition by i order by d2, j) as rk
   from pw) where rk = 1),
 tl as (select a.i, a.il as i_label, a.j, a.jl as j_label from nn a join nn b on a.i = b.j and a.j = b.i
   where a.il <> a.jl and a.i < a.j)"""
KEPT = "select key, label, synthetic"


def _resampled(strategy: str, **settings):
    return lambda spark, sf: R.resample(vectors(spark, sf), strategy, **settings).select("key", "label", "synthetic")


PLAIN = f"{VECTORS}, {_pairs('v', 'pw')}"
GROWN = f"{SMOTE}, {_pairs('w', 'pw')}"

def knn_join_lsh(spark, sf):
    """Recall of the approximate join by label, against the exact neighbours of all points."""
    points = vectors(spark, sf)
    size = points.count()
    found = L.nearest_neighbors_lsh(points, "key", "vector", 5)
    recall = L.lsh_recall(points, found, "key", "vector", 5, n=size)
    few = L.lsh_comparisons(points, "key", "vector", 5) < size * size
    by_label = recall.join(points.select("key", "label"), "key").groupBy("label")
    return by_label.agg(
        F.count(F.lit(1)).alias("queries"),
        F.sum("n_exact").alias("pairs"),
        (F.sum("n_found") > 0).alias("compared"),
        (F.sum("n_found") >= 0.9 * F.sum("n_exact")).alias("recall_reached"),
        F.lit(few).alias("fewer_than_all_pairs"),
    )


QUERIES = {
    "knn_join": (
        lambda spark, sf: rounded(
            N.knn_pairs(N.nearest_neighbors(vectors(spark, sf), "key", "vector", 5), "key"), 6
        ),
        f"with {VECTORS}, {_pairs('v')} select i, j, cast(rk as int) as rank, round(d2, 6) as d2 from {_near('pd', 5)}",
    ),
    "knn_join_blocks": (
        # The way taken by large tables: many blocks even at the smallest scale.
        lambda spark, sf: rounded(
            N.knn_pairs(N.nearest_neighbors(vectors(spark, sf), "key", "vector", 5, block_rows=128), "key"), 6
        ),
        f"with {VECTORS}, {_pairs('v')} select i, j, cast(rk as int) as rank, round(d2, 6) as d2 from {_near('pd', 5)}",
    ),
    "knn_join_small_side": (
        # The rare class against all: sent to every task, as for a table of any size.
        lambda spark, sf: rounded(
            N.knn_pairs(
                N.nearest_neighbors(vectors(spark, sf), "key", "vector", 5, queries=F.col("label") == 1, block_rows=1), "key"
            ),
            6,
        ),
        f"with {VECTORS}, {_pairs('v')} select i, j, cast(rk as int) as rank, round(d2, 6) as d2 from {_near('pd', 5, 'il = 1')}",
    ),
    "knn_join_lsh": (
        knn_join_lsh,
        f"""with {VECTORS}, {_pairs('v')}, n as {_near('pd', 5)}
   select il as label, count(distinct i) as queries, count(*) as pairs, sum(round(d2, 6)) > 0 as compared,
   true as recall_reached, true as fewer_than_all_pairs from n group by il""",
    ),
    "borderline_groups": (
        lambda spark, sf: R.borderline_groups(vectors(spark, sf)),
        f"with {ZONES} select key, n_majority, n_neighbors, zone from z",
    ),
    "borderline_smote": (
        lambda spark, sf: _shown(R.borderline_smote(vectors(spark, sf))),
        f"with {SMOTE} select key, label, synthetic, {SHOWN} from w",
    ),
    "enn_clean": (
        lambda spark, sf: R.enn_clean(vectors(spark, sf), 3).select("key", "label"),
        f"""with {PLAIN} select key, label from v where key not in
          (select i from {_votes('pw', 3, 'il = 0')} where against * 2 > votes)""",
    ),
    "enn_clean_any": (
        lambda spark, sf: R.enn_clean(vectors(spark, sf), 5, "any_disagree").select("key", "label"),
        f"""with {PLAIN} select key, label from v where key not in
          (select i from {_votes('pw', 5, 'il = 0')} where against > 0)""",
    ),
    "allknn_clean": (
        lambda spark, sf: R.allknn_clean(vectors(spark, sf), 5).select("key", "label"),
        f"with {PLAIN}, {_allknn('v', 5, True)} select key, label from a5",
    ),
    "allknn_clean_static": (
        lambda spark, sf: R.allknn_clean(vectors(spark, sf), 5, mode="static").select("key", "label"),
        f"with {PLAIN} select key, label from v where key not in ("
        + " union ".join(f"select i from {_votes('pw', k, 'il = 0')} where against * 2 > votes" for k in range(1, 6))
        + ")",
    ),
    "ncr_clean": (
        lambda spark, sf: R.ncr_clean(vectors(spark, sf), 3).select("key", "label"),
        f"""with {PLAIN}, {_ncr(3, '(select count(*) filter (label = 0) > 0.5 * count(*) filter (label = 1) from v)')}
          select key, label from v where key not in (select key from rm)""",
    ),
    "tomek_links": (
        lambda spark, sf: R.tomek_links(vectors(spark, sf)),
        f"with {PLAIN}, {TOMEK} select * from tl",
    ),
    "tomek_clean": (
        lambda spark, sf: R.tomek_clean(vectors(spark, sf)).select("key", "label"),
        f"""with {PLAIN}, {TOMEK} select key, label from v where key not in
          (select case when i_label = 0 then i else j end from tl)""",
    ),
    "resample_allknn": (
        _resampled("borderline_smote_allknn"),
        f"with {GROWN}, {_allknn('w', 5, True)} {KEPT} from w where key in (select key from a5)",
    ),
    "resample_ncr": (
        _resampled("borderline_smote_ncr"),
        f"""with {GROWN}, {_ncr(3, '(select count(*) filter (label = 0) > 1.0 * count(*) filter (label = 1) from w)')}
          {KEPT} from w where key not in (select key from rm)""",
    ),
    "resample_tomek": (
        _resampled("borderline_smote_tomek"),
        f"""with {GROWN}, {TOMEK} {KEPT} from w where key not in
          (select case when i_label = 0 then i else j end from tl)""",
    ),
}

# The way taken by large tables, with the same answers: many blocks at every scale.
MANY = {"block_rows": 64}
QUERIES |= {
    "borderline_smote_blocks": (
        lambda spark, sf: _shown(R.borderline_smote(vectors(spark, sf), **MANY)),
        QUERIES["borderline_smote"][1],
    ),
    "enn_clean_blocks": (
        lambda spark, sf: R.enn_clean(vectors(spark, sf), 3, **MANY).select("key", "label"),
        QUERIES["enn_clean"][1],
    ),
    "resample_allknn_blocks": (_resampled("borderline_smote_allknn", **MANY), QUERIES["resample_allknn"][1]),
    "resample_ncr_blocks": (_resampled("borderline_smote_ncr", **MANY), QUERIES["resample_ncr"][1]),
    "resample_tomek_blocks": (_resampled("borderline_smote_tomek", **MANY), QUERIES["resample_tomek"][1]),
}

"""Sources, audit, splits, cleaning."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tierwise.functions.lineage import checkpointed, shared_dir
from tierwise.operators import audit, cleaning, imputation, split
from tierwise.operators.preprocessing import build_preprocessor
from tierwise.plans.catalog.bindings import (
    CATEGORICAL,
    DIRTY,
    SCORED,
    categorical,
    dirty,
    documents,
    rounded,
    scored,
    table,
)
from tierwise.sources.files import read_csv, write_csv

RULES = [
    ("acctbal_negative", "c_acctbal", "{c} < 0"),
    ("name_negative", "c_name", "{c} < 0"),
    ("absent_column", "no_such_column", "{c} > 0"),
]


def csv_scan_nulls(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 10 == 0, "N/A").otherwise(F.col("o_custkey").cast("string")).alias("custkey"),
        F.when(F.col("o_orderkey") % 7 == 0, "nan").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.when(F.col("o_orderstatus") == "P", "NULL").otherwise(F.col("o_orderstatus")).alias("status"),
        (F.col("o_orderkey") % 2 == 0).cast("string").alias("even"),
    )
    return _through_csv(spark, orders)


def _through_csv(spark, df):
    path = f"{shared_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    write_csv(df, path)
    return read_csv(spark, path)


def csv_scan_text(spark, sf):
    """Whole texts with quotes and line breaks, and a number column with infinities."""
    docs = table(spark, sf, "documents")
    size = F.when(F.col("doc_id") % 5 == 0, "inf").when(F.col("doc_id") % 5 == 1, "-Infinity")
    return _through_csv(spark, docs.select("doc_id", "text", size.otherwise(F.col("n_chars").cast("string")).alias("size")))


CSV = """select o_orderkey, case when o_custkey % 10 <> 0 then o_custkey end as custkey,
  case when o_orderkey % 7 <> 0 then o_totalprice end as price,
  nullif(o_orderstatus, 'P') as status, o_orderkey % 2 = 0 as even from orders"""

CSV_TEXT = """select doc_id, text, case doc_id % 5 when 0 then 'inf'::double when 1 then '-inf'::double
  else n_chars::double end as size from documents"""

_COLUMNS = ["l_quantity", "l_extendedprice", "disc", "tax", "l_returnflag", "l_linestatus", "y"]
_NUMBERS = ["l_quantity", "l_extendedprice", "disc", "tax", "y"]


def _union(parts: list[str]) -> str:
    return " union all ".join(parts)


MISSING = f"with {DIRTY} " + _union(
    [
        f"select '{c}' as \"column\", count(*) - count({c}) as missing, "
        f"round((count(*) - count({c})) / cast(count(*) as double) * 100.0, 4) as missing_percent from d"
        for c in _COLUMNS
    ]
)

CLASSES = f"""with {DIRTY}, g as (select y as class, count(*) as count from d group by y)
select class, count, round(count / cast(sum(count) over () as double) * 100.0, 4) as percentage,
  round(min(count) over () / cast(sum(count) over () as double), 9) as minority_ratio from g"""


def _iqr(column: str) -> str:
    return f"""select '{column}' as "column", round(q1, 9) as q1, round(q3, 9) as q3, round(q3 - q1, 9) as iqr,
  round(q1 - 1.5 * (q3 - q1), 9) as lower_bound, round(q3 + 1.5 * (q3 - q1), 9) as upper_bound,
  count(*) filter ({column} < q1 - 1.5 * (q3 - q1) or {column} > q3 + 1.5 * (q3 - q1)) as outlier_count,
  round(count(*) filter ({column} < q1 - 1.5 * (q3 - q1) or {column} > q3 + 1.5 * (q3 - q1))
    / cast(count(*) as double) * 100.0, 4) as outlier_percent
from d, (select quantile_cont({column}, 0.25) as q1, quantile_cont({column}, 0.75) as q3 from d) group by q1, q3"""


IQR = f"with {DIRTY} " + _union([_iqr(c) for c in _NUMBERS])

DOMAIN = """select 'acctbal_negative' as rule, count(*) filter (c_acctbal < 0) as violations from customer
union all select 'name_negative', count(*) filter (try_cast(c_name as double) < 0) from customer
union all select 'absent_column', 0"""

DUPLICATES = f"""with {DIRTY}, x as (select l_quantity, disc, tax, l_returnflag from d)
select (select count(*) from x) - (select count(*) from (select distinct * from x)) as duplicate_rows"""

TYPES = f"with {DIRTY} " + _union(
    [
        f"select cast({i} as int) as position, '{c}' as \"column\", "
        f"'{'numeric' if c in _NUMBERS else 'categorical'}' as kind, count({c}) as present from d"
        for i, c in enumerate(_COLUMNS)
    ]
)


def _report_sql() -> str:
    parts = [
        "select 'shape' as section, 'table' as name, 'rows' as metric, cast(count(*) as double) as value from d",
        f"select 'shape', 'table', 'columns', {len(_COLUMNS)}.0",
        "select 'missing', \"column\", 'percent', missing_percent from missing",
        "select 'type', \"column\", 'is_numeric', case when kind = 'numeric' then 1.0 else 0.0 end from types",
        "select 'domain', 'quantity_high', 'violations', count(*) filter (l_quantity > 49) from d",
        "select 'target', cast(class as varchar), 'count', count from classes",
        "select 'target', cast(class as varchar), 'percentage', percentage from classes",
        "select 'target', cast(class as varchar), 'minority_ratio', minority_ratio from classes",
        "select 'duplicates', 'table', 'rows', (select count(*) from d) - (select count(*) from (select distinct * from d))",
    ]
    for m in ("q1", "q3", "iqr", "lower_bound", "upper_bound", "outlier_count", "outlier_percent"):
        parts.append(f"select 'iqr', \"column\", '{m}', {m} from iqr")

    def body(sql: str) -> str:
        return sql.split(DIRTY, 1)[1].lstrip(", ")

    classes = f"select * from (with {body(CLASSES)})"
    ctes = f"missing as ({body(MISSING)}), types as ({body(TYPES)}), classes as ({classes}), iqr as ({body(IQR)})"
    return (
        f"with {DIRTY}, {ctes} select section, name, metric, round(cast(value as double), 9) as value from ("
        + _union(parts)
        + ")"
    )


SPLIT_RANKS = f"""{SCORED}, r as (select key, y, row_number() over (partition by y
    order by md5(concat(cast(key as varchar), '|42')), key) as rn, count(*) over (partition by y) as n from s)"""
SPLIT = f"""{SPLIT_RANKS}, t as (select *, ceil(n * 0.2::double) as nt from r),
 u as (select *, nt + ceil((n - nt) * (0.15::double / (1.0::double - 0.2::double))) as nv from t),
 z as (select key, y, case when rn <= nt then 'test' when rn <= nv then 'valid' else 'train' end as split from u)"""


def stratified_split(spark, sf):
    return split.stratified_split(scored(spark, sf).drop("p"), "y", "key", 0.2, 0.15, 42)


def quantile_clip(spark, sf):
    df = dirty(spark, sf).select("l_quantity", "l_extendedprice", "disc", "tax")
    return rounded(cleaning.QuantileClipper(inputCols=df.columns, lower=0.01, upper=0.99).fit(df).transform(df))


def _clip_sql() -> str:
    cols = ["l_quantity", "l_extendedprice", "disc", "tax"]
    bounds = ", ".join(f"quantile_cont({c}, 0.01) as lo_{c}, quantile_cont({c}, 0.99) as hi_{c}" for c in cols)
    out = ", ".join(
        f"round(case when {c} is not null then least(greatest({c}, lo_{c}), hi_{c}) end, 9) as {c}" for c in cols
    )
    return f"with {DIRTY}, b as (select {bounds} from d) select {out} from d, b"


def mice_numeric(spark, sf):
    df = dirty(spark, sf).select("l_quantity", "disc", "tax").withColumn("quantity", F.col("l_quantity")).drop("l_quantity")
    chain = imputation.ChainedLinearImputer(
        inputCols=["disc", "tax"], maxIter=3, tol=0.0, solver="least_squares"
    )
    return rounded(chain.fit(df).transform(df))


def _mice_sql() -> str:
    rounds = 3
    ctes = [
        DIRTY,
        "t0 as (select l_quantity as quantity, disc as d0, tax as x0, coalesce(disc, (select median(disc) from d)) as disc,"
        " coalesce(tax, (select median(tax) from d)) as tax from d)",
    ]
    last = "t0"
    for i in range(1, rounds + 1):
        ctes.append(
            f"a{i} as (select quantity, d0, x0, coalesce(d0, m.b + m.a * tax) as disc, tax from {last}, "
            f"(select regr_slope(d0, tax) as a, regr_intercept(d0, tax) as b from {last} where d0 is not null) m)"
        )
        ctes.append(
            f"b{i} as (select quantity, d0, x0, disc, coalesce(x0, m.b + m.a * disc) as tax from a{i}, "
            f"(select regr_slope(x0, disc) as a, regr_intercept(x0, disc) as b from a{i} where x0 is not null) m)"
        )
        last = f"b{i}"
    return f"with {', '.join(ctes)} select round(disc, 9) as disc, round(tax, 9) as tax, quantity from {last}"


def mice_categorical(spark, sf):
    df = categorical(spark, sf).select("key", "cat", "grp")
    chain = imputation.ChainedCategoryImputer(inputCols=["cat", "grp"])
    return chain.fit(df).transform(df)


# Full trees without bootstrap give the mean code of each group; the only missing column
# has a single complete predictor here, so those means are the whole answer.
MICE_CATEGORICAL = f"""with {CATEGORICAL},
 k as (select cat, dense_rank() over (order by cat) - 1 as code from (select distinct cat from c where cat is not null)),
 m as (select grp, cast(round_even(avg(code), 0) as int) as code from c join k using (cat) group by grp)
select c.key, coalesce(c.cat, (select cat from k where k.code = m.code)) as cat, c.grp from c join m using (grp)"""


def round_clip_decode(spark, sf):
    df = categorical(spark, sf)
    known = cleaning.Dictionary.fit(df, ["cat"])
    return known.decode(df, {"decoded": (F.col("value") / 25.0 - 1.0, "cat")}).select("key", "decoded")


def encode_decode_keys(spark, sf):
    """A column with a category per customer there and back again."""
    df = table(spark, sf, "customer").select("c_custkey", "c_name")
    known = cleaning.Dictionary.fit(df, ["c_name"])
    coded = known.encode(df, {"code": "c_name"})
    return known.decode(coded, {"decoded": (F.col("code"), "c_name")})


DECODE = f"""with {CATEGORICAL} select key, list_extract(['click', 'purchase', 'signup', 'view'],
  cast(least(greatest(round_even(value / 25.0 - 1.0, 0), 0), 3) as int) + 1) as decoded from c"""


def ordinal_encode(spark, sf):
    df = categorical(spark, sf).select("key", "cat", "grp")
    known = df.where("cat is null or cat <> 'view'")
    return cleaning.OrdinalEncoder(inputCols=["cat", "grp"]).fit(known).transform(df)


ORDINAL = f"""with {CATEGORICAL}, k as (select * from c where cat is null or cat <> 'view'),
 kc as (select cat, dense_rank() over (order by cat) - 1 as code from (select distinct cat from k where cat is not null)),
 kg as (select grp, dense_rank() over (order by grp) - 1 as code from (select distinct grp from k))
select key, case when c.cat is not null then cast(coalesce(kc.code, -1) as double) end as cat,
  cast(coalesce(kg.code, -1) as double) as grp
from c left join kc on c.cat = kc.cat left join kg on c.grp = kg.grp"""


def preprocess_features(spark, sf):
    df = checkpointed(documents(spark, sf, gaps=True))  # the fit passes over it many times
    numeric, cats = ["n_chars", "n_words", "n_unique", "n_lines"], ["lang", "source"]
    fitted = build_preprocessor(numeric, cats, categorical_rounds=1, categorical_trees=3).fit(df)
    return rounded(fitted.transform(df).select("key", *numeric, *cats))


QUERIES = {
    "csv_scan_nulls": (csv_scan_nulls, CSV),
    "csv_scan_text": (csv_scan_text, CSV_TEXT),
    "audit_shape": (
        lambda spark, sf: audit.shape(dirty(spark, sf)),
        f"with {DIRTY} select count(*) as rows, cast(7 as bigint) as columns from d",
    ),
    "audit_missing_percent": (lambda spark, sf: audit.missing_percent(dirty(spark, sf)), MISSING),
    "audit_class_distribution": (
        lambda spark, sf: rounded(audit.class_distribution(dirty(spark, sf), "y")),
        CLASSES,
    ),
    "audit_iqr_outliers": (lambda spark, sf: rounded(audit.iqr_outliers(dirty(spark, sf))), IQR),
    "audit_domain_rules": (
        lambda spark, sf: audit.domain_violations(table(spark, sf, "customer"), RULES),
        DOMAIN,
    ),
    "audit_duplicate_rows": (
        lambda spark, sf: audit.duplicate_rows(dirty(spark, sf).select("l_quantity", "disc", "tax", "l_returnflag")),
        DUPLICATES,
    ),
    "audit_column_types": (lambda spark, sf: audit.column_types(dirty(spark, sf)), TYPES),
    "audit_report": (
        lambda spark, sf: rounded(
            audit.audit_report(dirty(spark, sf), "y", rules=[("quantity_high", "l_quantity", "{c} > 49")])
        ),
        _report_sql(),
    ),
    "stratified_split": (stratified_split, f"with {SPLIT} select key, y, split from z"),
    "split_summary": (
        lambda spark, sf: split.split_summary(stratified_split(spark, sf), "y"),
        f"with {SPLIT} select split, y as class, count(*) as count from z group by split, y",
    ),
    "stratified_folds": (
        lambda spark, sf: split.stratified_folds(scored(spark, sf).drop("p"), "y", "key", 5, 42),
        f"""with {SPLIT_RANKS} select key, y, cast((rn > ceil(n * 1 / 5.0::double))::int
          + (rn > ceil(n * 2 / 5.0::double))::int + (rn > ceil(n * 3 / 5.0::double))::int
          + (rn > ceil(n * 4 / 5.0::double))::int as int) as fold from r""",
    ),
    "quantile_clip": (quantile_clip, _clip_sql()),
    "impute_median": (
        lambda spark, sf: rounded(
            cleaning.impute_median(dirty(spark, sf), ["disc", "tax"]).select("l_quantity", "disc", "tax")
        ),
        f"""with {DIRTY} select l_quantity, round(coalesce(disc, (select median(disc) from d)), 9) as disc,
          round(coalesce(tax, (select median(tax) from d)), 9) as tax from d""",
    ),
    "impute_mode": (
        lambda spark, sf: cleaning.impute_mode(categorical(spark, sf).select("key", "cat"), ["cat"]),
        f"""with {CATEGORICAL}, m as (select cat from c where cat is not null group by cat
          order by count(*) desc, cat limit 1)
          select key, coalesce(cat, (select cat from m)) as cat from c""",
    ),
    "mice_numeric": (mice_numeric, _mice_sql()),
    "mice_categorical": (mice_categorical, MICE_CATEGORICAL),
    "round_clip_decode": (round_clip_decode, DECODE),
    "ordinal_encode": (ordinal_encode, ORDINAL),
    "encode_decode_keys": (
        encode_decode_keys,
        """select c_custkey, c_name, cast(dense_rank() over (order by c_name) - 1 as double) as code,
          c_name as decoded from customer""",
    ),
    "preprocess_features": (preprocess_features, None),
}

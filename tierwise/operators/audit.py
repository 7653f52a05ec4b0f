"""Data contract and audit: what a table holds before anything is learned from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tierwise.functions.fixed_values import DOMAIN_RULES
from tierwise.functions.lineage import checkpointed
from tierwise.functions.quantiles import exact_quantiles
from tierwise.functions.sizes import is_small

_LOW, _HIGH, _COPIES = "__tierwise_low", "__tierwise_high", "__tierwise_n"


def validate_schema(df: DataFrame, target: str, required: Sequence[str] = ()) -> None:
    if target not in df.columns:
        raise ValueError(f"target column {target!r} is missing")
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"required columns are missing: {absent}")


def numeric_columns(df: DataFrame) -> list[str]:
    """Numbers only; booleans count as categories in an audit."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def feature_types(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric features (booleans included) and the rest, each in column order."""
    numeric = [
        f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType))
    ]
    return numeric, [c for c in df.columns if c not in numeric]


def is_missing(field: T.StructField) -> Column:
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100.0, 4)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(df.columns)).cast("bigint").alias("columns")
    )


def column_types(df: DataFrame) -> DataFrame:
    """One row per column: its position, kind and number of present values."""
    numeric = set(numeric_columns(df))
    wide = df.agg(*[F.count_if(~is_missing(f)).alias(f"c{i}") for i, f in enumerate(df.schema)])
    return _rows(
        wide,
        [
            {
                "position": F.lit(i),
                "column": F.lit(f.name),
                "kind": F.lit("numeric" if f.name in numeric else "categorical"),
                "present": F.col(f"c{i}"),
            }
            for i, f in enumerate(df.schema)
        ],
    )


def missing_percent(df: DataFrame) -> DataFrame:
    wide = df.agg(F.count(F.lit(1)).alias("n"), *_missing_counts(df))
    return _rows(
        wide,
        [
            {
                "column": F.lit(c),
                "missing": F.col(f"miss{i}"),
                "missing_percent": percent(F.col(f"miss{i}"), F.col("n")),
            }
            for i, c in enumerate(df.columns)
        ],
    )


def class_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count and share of every class, the null class included."""
    counts = df.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("count"))
    every = Window.partitionBy()  # one row per class
    return counts.select(
        "class",
        "count",
        percent(F.col("count"), F.sum("count").over(every)).alias("percentage"),
        (F.min("count").over(every) / F.sum("count").over(every)).alias("minority_ratio"),
    ).orderBy("class")


def iqr_outliers(df: DataFrame, id_cols: Sequence[str] = ()) -> DataFrame:
    """Quartiles, fences and outliers per numeric column, the target among them."""
    columns, fences = _fences(df, id_cols)
    wide = df.agg(F.count(F.lit(1)).alias("n"), *_outlier_counts(columns, fences))
    if not columns:
        wide = wide.limit(0)
    return _rows(wide, [_fence_row(i, c, fences[c]) for i, c in enumerate(columns)] or [_fence_row(0, "", None)])


def domain_violations(df: DataFrame, rules: Sequence[tuple[str, str, str]] = DOMAIN_RULES) -> DataFrame:
    """Rows breaking each rule; text that is no number never does, nor does an absent column."""
    wide = df.agg(F.count(F.lit(1)).alias("n"), *_rule_counts(df, rules))
    return _rows(
        wide,
        [{"rule": F.lit(name), "violations": F.col(f"rule{i}")} for i, (name, _, _) in enumerate(rules)],
    )


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat another row in every column, nulls being equal.

    A 128-bit digest of each row is counted first.  Rows whose digest stands once are no copies and
    are never shuffled; the others are compared exactly.
    """
    if not df.columns:
        return df.agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(0)).alias("duplicate_rows"))
    # Two hashes over the values and over which of them are null: 16 bytes a row are shuffled.
    null = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in df.columns])
    columns = [F.col(f"`{c}`") for c in df.columns]
    low, high = F.xxhash64(F.lit(1), null, *columns), F.xxhash64(F.lit(2), *reversed(columns), null)
    marked = df.withColumns({_LOW: low, _HIGH: high})
    counts = marked.groupBy(_LOW, _HIGH).agg(F.count(F.lit(1)).alias(_COPIES)).where(F.col(_COPIES) > 1)
    counts = checkpointed(counts)
    if counts.isEmpty():
        return df.sparkSession.createDataFrame([(0,)], "duplicate_rows long")
    # Only rows of a repeated digest are compared in all columns; copies are summed up before the shuffle.
    again = marked.join(counts.select(_LOW, _HIGH).hint("broadcast" if is_small(counts) else "shuffle_hash"), [_LOW, _HIGH], "left_semi")
    copies = again.drop(_LOW, _HIGH).groupBy(*[f"`{c}`" for c in df.columns]).agg(F.count(F.lit(1)).alias(_COPIES))
    return copies.agg(F.coalesce(F.sum(F.col(_COPIES) - 1), F.lit(0)).alias("duplicate_rows"))


def audit_report(
    df: DataFrame,
    target: str,
    id_cols: Sequence[str] = (),
    rules: Sequence[tuple[str, str, str]] = DOMAIN_RULES,
) -> DataFrame:
    """All sections as one long table ``(section, name, metric, value)``.

    Every per-column statistic comes from a single pass over the table.
    """
    columns, fences = _fences(df, id_cols)
    numeric = set(numeric_columns(df))
    wide = df.agg(
        F.count(F.lit(1)).alias("n"),
        *_missing_counts(df),
        *_rule_counts(df, rules),
        *_outlier_counts(columns, fences),
    )
    n = F.col("n")
    cells = [("shape", "table", "rows", n), ("shape", "table", "columns", F.lit(len(df.columns)))]
    for i, c in enumerate(df.columns):
        cells.append(("missing", c, "percent", percent(F.col(f"miss{i}"), n)))
        cells.append(("type", c, "is_numeric", F.lit(int(c in numeric))))
    for i, (name, _, _) in enumerate(rules):
        cells.append(("domain", name, "violations", F.col(f"rule{i}")))
    for i, c in enumerate(columns):
        for metric, value in _fence_row(i, c, fences[c]).items():
            if metric != "column":
                cells.append(("iqr", c, metric, value))
    single = _rows(
        wide,
        [
            {"section": F.lit(s), "name": F.lit(c), "metric": F.lit(m), "value": v.cast("double")}
            for s, c, m, v in cells
        ],
    )
    classes = class_distribution(df, target)
    label = F.coalesce(F.col("class").cast("string"), F.lit("null"))
    class_rows = classes.select(
        F.lit("target").alias("section"),
        label.alias("name"),
        F.posexplode(
            F.array(F.col("count").cast("double"), "percentage", "minority_ratio")
        ).alias("_at", "value"),
    ).select(
        "section",
        "name",
        F.element_at(F.array(F.lit("count"), F.lit("percentage"), F.lit("minority_ratio")), F.col("_at") + 1).alias(
            "metric"
        ),
        "value",
    )
    copies = duplicate_rows(df).select(
        F.lit("duplicates").alias("section"),
        F.lit("table").alias("name"),
        F.lit("rows").alias("metric"),
        F.col("duplicate_rows").cast("double").alias("value"),
    )
    return single.unionByName(class_rows).unionByName(copies)


def _rows(wide: DataFrame, records: list[dict[str, Column]]) -> DataFrame:
    """Turn one wide row into the given records."""
    structs = [F.struct(*[v.alias(k) for k, v in r.items()]) for r in records]
    return wide.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def _missing_counts(df: DataFrame) -> list[Column]:
    return [F.count_if(is_missing(f)).alias(f"miss{i}") for i, f in enumerate(df.schema)]


def _rule_counts(df: DataFrame, rules) -> list[Column]:
    out = []
    for i, (_, column, predicate) in enumerate(rules):
        if column in df.columns:
            number = f"nanvl(try_cast(`{column}` as double), null)"
            hit = F.expr(predicate.format(c=number))
        else:
            hit = F.lit(False)
        out.append(F.count_if(hit).alias(f"rule{i}"))
    return out


def _fences(df: DataFrame, id_cols: Sequence[str]):
    columns = [c for c in numeric_columns(df) if c not in set(id_cols)]
    fences = {}
    for c, (q1, q3) in exact_quantiles(df, columns, [0.25, 0.75]).items():
        if q1 is None:
            fences[c] = None
        else:
            iqr = q3 - q1
            fences[c] = (q1, q3, iqr, q1 - 1.5 * iqr, q3 + 1.5 * iqr)
    return columns, fences


def _outlier_counts(columns: Sequence[str], fences: dict) -> list[Column]:
    out = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`").cast("double")
        value = F.when(~F.isnan(value), value)
        hit = F.lit(False)
        if fences[c] is not None:
            hit = (value < F.lit(fences[c][3])) | (value > F.lit(fences[c][4]))
        out.append(F.count_if(hit).alias(f"out{i}"))
    return out


def _fence_row(i: int, column: str, fence) -> dict[str, Column]:
    values = fence or (None,) * 5
    count = F.col(f"out{i}") if fence is not None or column else F.lit(0).cast("bigint")
    names = ["q1", "q3", "iqr", "lower_bound", "upper_bound"]
    row = {"column": F.lit(column)}
    row.update({k: F.lit(v).cast("double") for k, v in zip(names, values)})
    row["outlier_count"] = count
    row["outlier_percent"] = percent(count, F.col("n"))
    return row

"""Reading datasets and writing reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tierwise.functions.fixed_values import CSV_NULL_TOKENS

NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
WHOLE = r"^\s*[+-]?\d+\s*$"
TRUTH = r"^(True|TRUE|true|False|FALSE|false)$"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    null_tokens: Sequence[str] = CSV_NULL_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header; every null token becomes NULL, then columns are typed.

    Without ``schema`` the types are found in one pass over the file: whole numbers,
    numbers, booleans, else text.  Quoted fields may hold line breaks, for which a task reads
    a whole file; files known to have none can be split with ``multi_line=False``.
    """
    raw = (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    clean = raw.select(*[_untoken(c, null_tokens).alias(c) for c in raw.columns])
    if schema is None:
        schema = infer_types(clean)
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    absent = [f.name for f in schema if f.name not in raw.columns]
    if absent:
        raise ValueError(f"columns are missing from the file: {absent}")
    return clean.select(
        *[
            F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )


def infer_types(text: DataFrame) -> T.StructType:
    """Narrowest type that fits every present value of each text column."""
    checks = []
    for i, c in enumerate(text.columns):
        value = F.col(f"`{c}`")
        checks += [
            F.count(value).alias(f"n{i}"),
            F.count_if(value.rlike(WHOLE) & value.try_cast("bigint").isNotNull()).alias(f"w{i}"),
            F.count_if(value.rlike(NUMBER)).alias(f"d{i}"),
            F.count_if(value.rlike(TRUTH)).alias(f"b{i}"),
        ]
    row = text.agg(*checks).first()
    fields = []
    for i, c in enumerate(text.columns):
        n, whole, number, truth = (row[4 * i + j] for j in range(4))
        if n and whole == n:
            kind: T.DataType = T.LongType()
        elif n and number == n:
            kind = T.DoubleType()
        elif n and truth == n:
            kind = T.BooleanType()
        else:
            kind = T.StringType()
        fields.append(T.StructField(c, kind))
    return T.StructType(fields)


def _untoken(name: str, tokens: Sequence[str]) -> Column:
    value = F.col(f"`{name}`")
    return F.when(~value.isin(*tokens), value)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN read as missing, for sources that store it."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(f"`{c}`"), F.col(f"`{c}`")) for c in floats})


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A report as JSON records, null fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One JSON document per file (or an array of them), typed by a pinned schema."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_splits(split: DataFrame, path: str) -> None:
    """Train, valid and test rows, target included, in one folder each."""
    split.write.mode("overwrite").partitionBy("split").option("header", True).csv(path)

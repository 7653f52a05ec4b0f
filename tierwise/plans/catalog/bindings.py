"""The given tables in the shapes the operators take, for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round floating columns, whose last digits depend on the order of summation."""
    doubles = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.round(F.col(c), digits) for c in doubles})


# ---- scored rows: key, y, p (with a user and run for grouping)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("key"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        (value / (value + 100.0)).alias("p"),
    )


SCORED = """s as (select event_id as key, cast(event_type = 'purchase' as int) as y,
  value / (value + 100.0) as p, user_id from events)"""


def scored_ties(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("key"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        (F.floor(F.col("value") / 25.0) / 20.0).alias("p"),
    )


SCORED_TIES = """s as (select event_id as key, cast(event_type = 'purchase' as int) as y,
  floor(value / 25.0) / 20.0 as p from events)"""


def scored_steps(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_id").alias("key"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        (F.floor("value") / 1000.0).alias("p"),
    )


SCORED_STEPS = """s as (select event_id as key, cast(event_type = 'purchase' as int) as y,
  floor(value) / 1000.0 as p from events)"""


def scored_by_user(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("key"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        (value / (value + 100.0)).alias("p"),
        "user_id",
        F.concat(F.lit("run_"), (F.col("user_id") % 5).cast("string")).alias("run_id"),
    )


SCORED_RUNS = """s as (select event_id as key, cast(event_type = 'purchase' as int) as y,
  value / (value + 100.0) as p, user_id, 'run_' || cast(user_id % 5 as varchar) as run_id from events)"""


# ---- a flat table with gaps


def dirty(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        "l_quantity",
        "l_extendedprice",
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("disc"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"),
        "l_returnflag",
        "l_linestatus",
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
    )


DIRTY = """d as (select l_quantity, l_extendedprice, nullif(l_discount, 0) as disc, nullif(l_tax, 0) as tax,
  l_returnflag, l_linestatus, cast(l_returnflag = 'R' as int) as y from lineitem)"""


def categorical(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("key"),
        F.when(kind != "error", kind).alias("cat"),
        (F.col("user_id") % 7).cast("string").alias("grp"),
        "value",
    )


CATEGORICAL = """c as (select event_id as key, nullif(event_type, 'error') as cat,
  cast(user_id % 7 as varchar) as grp, value from events)"""


# ---- vectors


def vectors(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("key"),
        (F.col("label") == 0).cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


VECTORS = """v as (select vec_id as key, cast(label = 0 as int) as label,
  list_transform(embedding, lambda e: cast(e as double)) as vector from embeddings)"""


# ---- documents with a rare label


def documents(spark: SparkSession, sf: str, gaps: bool = False) -> DataFrame:
    words = F.split("text", r"\s+")
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(words).cast("double").alias("n_words"),
        F.size(F.array_distinct(words)).cast("double").alias("n_unique"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        "lang",
        "source",
    )
    labels = table(spark, sf, "labels").select("doc_id", "toxic", (1 - F.col("quality")).alias("poor"))
    joined = docs.join(labels, "doc_id").withColumnRenamed("doc_id", "key")
    if gaps:
        joined = joined.withColumns(
            {
                "n_lines": F.when(F.col("key") % 13 != 0, F.col("n_lines")),
                "lang": F.when(F.col("key") % 11 != 0, F.col("lang")),
            }
        )
    return joined

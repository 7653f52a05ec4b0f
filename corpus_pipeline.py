"""A training corpus from raw documents: five stages, each over all that the one before kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwise.functions.lineage import shared_dir
from tierwise.llm.decontamination import drop_contaminated
from tierwise.llm.frames import table
from tierwise.llm.language_id import fit, keep_identified
from tierwise.llm.mixing import mix_sources
from tierwise.llm.near_dedup import drop_near_duplicates
from tierwise.llm.substrings import remove_repeated


#: Target weights: 1 keeps the shares of the sources, 0 makes them equal; between, small ones gain.
FLATTEN = 0.7


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is undetermined or in doubt go."""
    return keep_identified(docs, fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document of least id stays."""
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages go that start in an earlier document too; a text that loses none stays as it is,
    and a document that loses all its words goes."""
    # Columns of the documents stay, whatever they are called.
    passed = {c: f"__passed_{c}" for c in docs.columns if c in ("n_words", "n_removed", "kept_text")}
    cut = remove_repeated(docs.withColumnsRenamed(passed)).where("n_removed < n_words or n_words = 0")
    changed = F.col("n_removed") > 0
    cut = cut.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        counted = F.length("text").cast(docs.schema["n_chars"].dataType)
        cut = cut.withColumn("n_chars", F.when(changed, counted).otherwise(F.col("n_chars")))
    return cut.drop("n_words", "n_removed", "kept_text").withColumnsRenamed({v: k for k, v in passed.items()}).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources get shares by their size to the power FLATTEN; rows are ``doc_id, source, block, slot, position``."""
    sizes = {r["source"]: r["count"] for r in docs.groupBy("source").count().collect()}  # one row a source
    return mix_sources(docs, {source: n**FLATTEN for source, n in sizes.items()})


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
]

#: Language ID and near duplicates cannot be said in SQL; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    *first, (_, last) = STAGES
    for name, stage in first:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return last(spark, docs, sf_dir)

"""Small helpers on DataFrames shared by the operators of this subpackage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwise.functions.lineage import checkpointed

__all__ = ["checkpointed", "partitions", "text_bytes", "table", "settled", "word_array", "broadcast_if_small"]

#: What ``split`` takes as the space between words; other white space belongs to words.
WORD_GAP = r"[ \t\n\x0B\f\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(df: DataFrame, column: str) -> int:
    """Bytes of all texts of a column, from one pass over it."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def pieces(spark: SparkSession, nbytes: int, each: int) -> int:
    """How many pieces of about ``each`` bytes to deal the input into; no fewer than shuffle partitions."""
    return max(partitions(spark), math.ceil(nbytes / each))


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are worked out once a row.

    Filters on plain columns are pushed below them, and expressions over them are merged, which
    copies a costly expression into each place that reads it; neither passes a generator.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def word_array(text: Column) -> Column:
    """The words of a text; null and empty texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def broadcast_if_small(df: DataFrame, rows: int, most: int) -> DataFrame:
    """Marks a side for broadcast where its counted ``rows`` are ``most`` or fewer."""
    return F.broadcast(df) if rows <= most else df

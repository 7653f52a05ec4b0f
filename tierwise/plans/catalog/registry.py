"""All registered queries: name to Spark callable, and to SQL where one can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tierwise.plans.catalog import auditing, balancing, measuring, modelling

_PARTS = (auditing.QUERIES, measuring.QUERIES, balancing.QUERIES, modelling.QUERIES)


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for part in _PARTS for name, (fn, _) in part.items()}


def sql_queries() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, (_, sql) in part.items() if sql is not None}

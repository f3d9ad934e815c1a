"""The registered queries: each a Spark plan and, where SQL can express it, the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarrymill.plans import columns, listings, more, pages, rest, streams, tables, texts

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return listings.QUERIES | texts.QUERIES | tables.QUERIES | rest.QUERIES | more.QUERIES | streams.QUERIES | pages.QUERIES | columns.QUERIES


def oracle_sql() -> dict[str, str]:
    return listings.SQL | texts.SQL | tables.SQL | rest.SQL | more.SQL | streams.SQL | pages.SQL | columns.SQL


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.cohort_cascade(spark, sf_dir)

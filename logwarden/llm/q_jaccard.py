"""Registered query of the n-gram Jaccard join.  All pairs in SQL are too slow on whole tables; tests use brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logwarden.llm.common import table
from logwarden.llm.jaccard_join import jaccard_groups


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"), k=4, threshold=(85, 100))


QUERIES = {"op5_jaccard_join": op5_jaccard_join}
ORACLE: dict[str, str] = {}

"""Registered query of embedding whitening; tests compare it with dense linear algebra."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.llm.common import table
from logwarden.llm.whitening import whiten


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(table(spark, sf_dir, "embeddings"), components=32, weights="counts")
    # beyond 64 bits there is no long to give
    return white.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


QUERIES = {"op11_whitening": op11_whitening}
ORACLE: dict[str, str] = {}

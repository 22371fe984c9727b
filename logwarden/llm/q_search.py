"""Registered queries of line dedup and nearest neighbours; tests compare them with brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.llm.ann import nearest
from logwarden.llm.common import table
from logwarden.llm.line_dedup import dedup_passages


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_passages(table(spark, sf_dir, "documents"), min_words=50)
    return found.select("doc_id", "n_lines", F.size("deleted_lines").cast("long").alias("n_deleted"), "deleted_lines", "deleted_words", F.sha2("text", 256).alias("kept_sha256"))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


QUERIES = {"op1_line_dedup": op1_line_dedup, "op3_nearest": op3_nearest}
ORACLE: dict[str, str] = {}

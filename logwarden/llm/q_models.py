"""Registered queries of the quality classifier and of language identification; tests measure held-out accuracy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.llm.common import table
from logwarden.llm.langid import fit_languages, identify
from logwarden.llm.quality import score_quality


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"))


def held_out():
    """Rows that nothing may be learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs, ~held_out())
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {"op4_quality": op4_quality, "op9_language_id": op9_language_id}
ORACLE: dict[str, str] = {}

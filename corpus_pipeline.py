"""From raw documents to token files: quality, exact copies, near copies, source mix, byte-level BPE.

Every stage takes what its predecessor kept, as Parquet read back, and gives the columns of ``documents``; the last one
gives tokens.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.llm.bpe import tokenize
from logwarden.llm.common import stored, table
from logwarden.llm.exact_dedup import exact_dedup
from logwarden.llm.jaccard_join import jaccard_groups
from logwarden.llm.mixing import mixed_rows
from logwarden.llm.q_tables import vocabulary
from logwarden.llm.quality import keep_quality

WEIGHTS, BUDGET_RATIO, MAX_REPEATS = (3, 1, 2), 1.5, 2


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return keep_quality(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal without white space, the longest, then that of the smallest id."""
    gone = exact_dedup(docs).where("NOT kept").select("doc_id")
    return docs.join(stored(gone, "pipeline-copies"), "doc_id", "left_anti").select(*docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 over five-word shingles, that of the smallest id."""
    groups = jaccard_groups(docs, k=5, threshold=(80, 100))
    gone = groups.where("doc_id != component_id").select("doc_id")
    return docs.join(stored(gone, "pipeline-near"), "doc_id", "left_anti").select(*docs.columns)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source near its target: rows are left out, or repeated as often as the mix takes them."""
    return mixed_rows(docs, WEIGHTS, BUDGET_RATIO, MAX_REPEATS)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit numbers), and the digests of ids and of the decoded text."""
    tokens = tokenize(docs, *vocabulary())
    return tokens.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing sources", mix_stage),
    ("byte-level BPE", token_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read back; the tokens of what is left."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{number}")
    return docs


#: A trained scorer, shingle links and merges by rank are not expressible; tests compare with a brute-force version.
ORACLE_SQL = None

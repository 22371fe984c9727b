"""Registered query of SentencePiece encoding; tests compare it with the installed tokenizer library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.llm.common import table
from logwarden.llm.sentencepiece_bpe import piece_tokens

MODEL = "piece_bpe_32k.model"


def model_file() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(MODEL), "rb") as file:
        return file.read()


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = piece_tokens(table(spark, sf_dir, "documents"), model_file())
    digits = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return tokens.select("doc_id", "n_tokens", F.sha2(digits, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op13_sentencepiece": op13_sentencepiece}
ORACLE: dict[str, str] = {}

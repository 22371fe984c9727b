"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import in_bitmap, key_bitmap, stored, without_spaces

PREFIX_CHARS = 64
BITMAP_BUCKETS = 256  # 1 MiB


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=without_spaces,
                prefix_chars: int = PREFIX_CHARS, bitmap_buckets: int = BITMAP_BUCKETS, digest_all: bool = False) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept and text_sha256 (null for most unique texts unless ``digest_all``).

    Texts are equal when ``normalise`` makes them identical.  Of equal texts the one with the most code points in its
    original text stays, then the smallest id (a null id last).  A first read groups by length and prefix hash.  The
    groups that hold more than one row are kept as a bitmap of fixed size, and the second read makes the full hash
    only of rows that the bitmap lets through.  Rows with the full hash are then counted: partial sums in every task
    first, so a group of copies of any size sends one row per task; the join that carries the result back to the rows
    is one Spark splits when a group is large.

    Null and empty texts are equal to each other.  Repeated rows with one id are copies; of rows that agree in text
    and id, all are marked as kept, because nothing tells them apart.  Other columns are not read.
    """
    text: Column = F.col(text_col)
    slim = docs.select(
        F.col(id_col).alias("id"), F.char_length(F.coalesce(text, F.lit(""))).alias("chars"), normalise(text).alias("body"))
    rows = slim.select(
        "id", "chars", "body", F.octet_length("body").alias("bytes"))
    keyed = rows.withColumn("prefix", F.xxhash64("bytes", F.substring("body", 1, prefix_chars)))
    # lengths first: a length that occurs once needs no look at its prefix
    groups = keyed.groupBy("bytes", "prefix").agg(F.count("*").alias("n")).where("n > 1").select("prefix")
    bitmap = stored(key_bitmap(groups, "prefix", bitmap_buckets), "dedup-bitmap")
    flagged = in_bitmap(keyed, "prefix", bitmap, bitmap_buckets, "maybe")
    wanted = F.lit(True) if digest_all else F.col("maybe")
    hashed = stored(flagged.select(
        "id", "chars", "bytes", "maybe", F.when(wanted, F.sha2(F.col("body").cast("binary"), 256)).alias("sha")), "dedup-hashed")
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.col("id").isNull().alias("nil"), F.col("id").alias("id")))
    copies = (hashed.where("maybe").groupBy("bytes", "sha").agg(F.count("*").alias("n"), best.alias("best"))
              .where("n > 1").select("bytes", "sha", "n", F.col("best.id").alias("keep"), F.col("best.c").alias("c")))
    found = hashed.join(stored(copies, "dedup-groups"), ["bytes", "sha"], "left")
    single = F.col("n").isNull()
    return found.select(
        F.col("id").alias(id_col),
        F.when(single, F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("keep").eqNullSafe(F.col("id")) & (F.col("c") == -F.col("chars")))).alias("kept"),
        F.col("sha").alias("text_sha256"))

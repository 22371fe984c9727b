"""Log files as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.common import operator
from logwarden.operators.parsing import strip


def decoded(line: Column) -> Column:
    """The line without bytes that are not UTF-8."""
    repaired = F.replace(F.make_valid_utf8(line), F.lit("�"), F.lit(""))
    return F.when(F.is_valid_utf8(line), line).otherwise(repaired)


def read_logs(spark: SparkSession, path: str, pattern: str = "*.log", line_numbers: bool = False) -> DataFrame:
    """(file_path, line_number, raw_log) of the log files under ``path``; blank lines are dropped.

    Text scans have no row index, so ``line_number`` is null unless asked for.  Then each scan split
    counts its lines, and the counts of earlier splits of the file are added: files stay splittable.
    """
    text = spark.read.text(path, pathGlobFilter=pattern).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_split"),
        strip(decoded(F.col("value"))).alias("raw_log"),
    )
    if not line_numbers:
        return text.where("raw_log <> ''").select("file_path", F.lit(None).cast("bigint").alias("line_number"), "raw_log")
    from pyspark.sql import Window

    # rows of a split are read in order by one task, so their ids are consecutive
    numbered = text.withColumn("_id", F.monotonically_increasing_id())
    splits = numbered.groupBy("file_path", "_split").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("file_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    return (
        numbered.join(offsets, ["file_path", "_split"])
        .where("raw_log <> ''")
        .select("file_path", (F.col("_id") - F.col("_first") + F.col("_before") + 1).alias("line_number"), "raw_log")
    )


@operator
def src_threat_feed(feed: DataFrame, ioc: DataFrame, feed_name: str = "misp") -> DataFrame:
    """Indicators of a feed (value, type, threat_type) that are not listed yet, one row per value."""
    from logwarden.common import first_per_key

    fresh = first_per_key(feed, ["value"], [F.asc("type"), F.asc("threat_type")]).join(ioc.select("value"), "value", "left_anti")
    return fresh.select(
        F.col("type").alias("ioc_type"), "value", "threat_type", F.lit(f"imported_{feed_name}").alias("source"), F.lit(True).alias("is_active")
    )

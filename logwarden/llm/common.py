"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from logwarden.session import checkpoint_dir

#: White space of the contracts: space and the five control characters from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
#: A word is a maximal run of other characters.
WORD = r"[^\x20\x09-\x0D]+"

BITMAP_BITS = 8 * 4096  # what one value of bitmap_construct_agg() holds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Let the session hand texts to Python in record batches of at most ``most`` bytes (Spark's own limit is 64 MiB).

    A batch is held several times over, by the JVM and by Python, in every running task.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    # the setting may carry a unit, such as 64m or 67108864b
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name, "64m"))
    if now > most:
        spark.conf.set(name, str(most))


def stored(df: DataFrame, name: str, group: str = "") -> DataFrame:
    """``df`` written once to the shared folder and read back.

    This cuts the lineage (a lost executor costs no recomputation of earlier stages), and as Spark knows the size
    of the files, a small table is broadcast only after Spark's own size check.  The folders stay under
    ``<spark.checkpoint.dir>/logwarden-llm/``, because lazy results read them; see :func:`clear_stored`.  Tables of one
    ``group`` can be removed together.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/logwarden-llm/{group}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_group(name: str) -> str:
    """A name for the tables of one call."""
    return f"{name}-{uuid.uuid4().hex}"


def clear_stored(spark: SparkSession, group: str = "") -> None:
    """Remove what :func:`stored` wrote, or one group of it; call it when the results have been written elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/logwarden-llm/{group}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without_spaces(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, keys: list[str], name: str, column: str = "row") -> DataFrame:
    """Stored rows of ``df`` with gapless numbers from 0 in the order of ``keys``.

    The rows are dealt out by ranges of the keys and sorted in each task, which numbers its own rows; the offset of
    a task is the number of rows in the tasks before it.  Only one row per task meets in one place.  Rows that
    agree in all keys may change places; a last key that tells them apart keeps a large group out of one task.
    """
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = stored(placed, name)
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # one row per task: bounded by the number of partitions
    joined = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    number = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    return joined.select(*df.columns, number.alias(column))


def key_bitmap(keys: DataFrame, column: str, buckets: int) -> DataFrame:
    """A bitmap of the hashes in ``column``: rows (bucket, bits), at most ``buckets`` of 4 KiB each.

    Its size depends on ``buckets`` only, so it can be broadcast whatever the number of keys; more keys make it
    less selective, never wrong, because every key it lets through is looked at exactly.
    """
    place = F.pmod(F.col(column), F.lit(buckets * BITMAP_BITS))
    return keys.groupBy(F.floor(place / BITMAP_BITS).cast("int").alias("_bucket")).agg(
        F.bitmap_construct_agg((place % BITMAP_BITS)).alias("_bits"))


def in_bitmap(df: DataFrame, column: str, bitmap: DataFrame, buckets: int, flag: str) -> DataFrame:
    """``df`` with a boolean ``flag``: may the hash in ``column`` be one of the bitmap's keys?"""
    place = F.pmod(F.col(column), F.lit(buckets * BITMAP_BITS))
    bit = place % BITMAP_BITS
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.expr("pmod(floor(_byte / power(2, _bit % 8)), 2) = 1")
    return (df.withColumn("_bucket", F.floor(place / BITMAP_BITS).cast("int")).join(F.broadcast(bitmap), "_bucket", "left")
            .withColumns({"_byte": byte, "_bit": bit})
            .withColumn(flag, F.coalesce(hit, F.lit(False))).drop("_bucket", "_bits", "_byte", "_bit"))

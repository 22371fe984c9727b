"""Sliding counts by adding and taking away.

Spark evaluates a sliding range frame by going through the whole frame again for each row, so a
long window over a busy key costs rows x frame.  Here each occurrence adds its count when it enters
the window and takes it away when it leaves; a running total then costs one addition per row.

A key that holds most rows is first reduced to one row per second and then cut into time blocks, so
no task sees more than the seconds of one block, whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86400


def in_blocks(df: DataFrame, sec: str, window_s: int) -> tuple[DataFrame, int]:
    """Assign rows to time blocks; rows within ``window_s`` of a block's end also go to the next
    one, where they only serve as context.  Adds ``_block`` and ``_own``.

    Blocks are at least eight windows long, so at most an eighth of the time range is repeated.
    """
    block_s = max(3600, 8 * window_s)
    block = F.floor(F.col(sec) / block_s)
    carried = F.col(sec) + window_s >= (block + 1) * block_s
    placed = df.withColumn(
        "_block", F.explode(F.when(carried, F.array(block, block + 1)).otherwise(F.array(block)))
    )
    return placed.withColumn("_own", F.col("_block") == block), block_s


def running_totals(deltas: DataFrame, keys: list[str], sec: str, totals: list[str], block_s: int = DAY) -> DataFrame:
    """Total of every column of ``totals`` per key up to and including each second.

    Within a block by a running window; across blocks by the block sums, of which a key has one
    per day.
    """
    block = F.floor(F.col(sec) / block_s)
    per_second = deltas.groupBy(*keys, block.alias("_block"), sec).agg(*[F.sum(c).alias(c) for c in totals])
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        per_second.groupBy(*keys, "_block")
        .agg(*[F.sum(c).alias(c) for c in totals])
        .select(*keys, "_block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_before_{c}") for c in totals])
    )
    within = Window.partitionBy(*keys, "_block").orderBy(sec)
    running = per_second.withColumns({c: F.sum(c).over(within) for c in totals})
    return running.join(offsets, [*keys, "_block"]).select(
        *keys, sec, *[(F.col(c) + F.col(f"_before_{c}")).alias(c) for c in totals]
    )


def step(sec: Column, **changes) -> Column:
    """One change record for :func:`F.inline`."""
    return F.struct(sec.cast("bigint").alias("sec"), *[c.cast("bigint").alias(n) for n, c in changes.items()])

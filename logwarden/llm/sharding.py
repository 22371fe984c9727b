"""Reproducible shuffle into shards: a Feistel permutation with cycle walking over global row numbers."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logwarden.llm.common import numbered

ROUNDS = 6


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int) -> list[int]:
    with np.errstate(over="ignore"):
        return [int(k) for k in _mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) + np.uint64(seed), seed)]


def _walk(step, x: np.ndarray, n: int) -> np.ndarray:
    """``step`` permutes 0 to side² - 1; repeat it for every number that lands at ``n`` or above."""
    x = step(x.astype(np.uint64))
    while (out := x >= np.uint64(n)).any():
        x[out] = step(x[out])
    return x.astype(np.int64)


def permute(rows: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Position of each row number in a pseudo-random order of 0 to n - 1.

    The rounds work on the pairs (left, right) below the smallest side with side² >= n, so few numbers walk.
    """
    side = np.uint64(isqrt(max(n - 1, 0)) + 1)

    def step(x):
        left, right = x // side, x % side
        for key in _keys(seed):
            left, right = right, (left + _mix(right, key) % side) % side
        return left * side + right

    return _walk(step, np.asarray(rows), n)


def unpermute(positions: np.ndarray, n: int, seed: int) -> np.ndarray:
    """The row numbers at these positions: :func:`permute` backwards."""
    side = np.uint64(isqrt(max(n - 1, 0)) + 1)

    def step(x):
        left, right = x // side, x % side
        for key in reversed(_keys(seed)):
            left, right = (right + side - _mix(left, key) % side) % side, left
        return left * side + right

    return _walk(step, np.asarray(positions), n)


def row_at(shard: int, slot: int, n: int, shards: int, seed: int) -> int:
    """Which row lies at a slot of a shard; needs no table."""
    return int(unpermute(np.array([slot * shards + shard]), n, seed)[0])


def shard_rows(docs: DataFrame, shards: int, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size (UTF-8 bytes + 8), text_crc32, row, position, shard and slot.

    Rows are numbered from 0 by id (null first), then size and checksum; the numbers depend on the table's content
    only, not on how it is stored.  The permutation turns a row number into a position; shard = position mod shards
    and slot = position div shards, so shards differ by one row at most, slots have no gaps, and :func:`row_at`
    finds any place again.  A null text has size 8 and the checksum of an empty one.  Repeated rows get places of
    their own.  Only id, size and checksum are shuffled, never the texts.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.monotonically_increasing_id().alias("_tie"))
    rows = numbered(slim, ["id", "size", "text_crc32", "_tie"], "shard-rows")
    n = (rows.agg(F.max("row")).first()[0] or 0) + 1

    @F.pandas_udf("long")
    def position(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(permute(batch.to_numpy(), n, seed))

    placed = rows.withColumn("position", position("row"))
    return placed.select(
        F.col("id").alias(id_col), "size", "text_crc32", "row", "position",
        (F.col("position") % shards).cast("int").alias("shard"),
        F.floor(F.col("position") / shards).cast("long").alias("slot"))

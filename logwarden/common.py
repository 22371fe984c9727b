"""Small helpers shared by the operators."""

from __future__ import annotations

import functools
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def operator(fn):
    """Let callers use their own column names: ``cols={"source_ip": "client", …}``.

    Every DataFrame argument is read under the standard names and the result is given back
    under the caller's names.
    """

    @functools.wraps(fn)
    def wrapper(*args, cols: dict[str, str] | None = None, **kwargs):
        if not cols:
            return fn(*args, **kwargs)
        inward = {mine: standard for standard, mine in cols.items()}

        def rename(value):
            return value.withColumnsRenamed(inward) if isinstance(value, DataFrame) else value

        result = fn(*map(rename, args), **{k: rename(v) for k, v in kwargs.items()})
        return result.withColumnsRenamed(cols) if isinstance(result, DataFrame) else result

    return wrapper


def as_of_col(df: DataFrame, as_of, ts: str = "timestamp") -> Column:
    """``as_of`` as a column; by default the newest ``ts`` of ``df`` as a scalar subquery.

    A literal is better on large tables: it reaches the file scan as a pushed filter.
    """
    if as_of is None:
        return df.agg(F.max(ts)).scalar()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        as_of = as_of.isoformat(sep=" ")
    return F.lit(as_of).cast("timestamp")


def before(as_of: Column, seconds: int) -> Column:
    return as_of - F.expr(f"INTERVAL {int(seconds)} SECOND")


def ladder(score: Column, bands: Iterable[tuple[float | None, str]]) -> Column:
    """First label whose lower bound the score reaches; bands run from high to low."""
    column: Column | None = None
    for low, label in bands:
        if low is None:
            return F.lit(label) if column is None else column.otherwise(label)
        hit = score >= F.lit(float(low))
        column = F.when(hit, label) if column is None else column.when(hit, label)
    return column


def lookup(key: Column, table: dict, default) -> Column:
    """Value of a small constant table, ``default`` for other keys."""
    column = None
    for name, value in table.items():
        column = F.when(key == name, F.lit(value)) if column is None else column.when(key == name, F.lit(value))
    return column.otherwise(F.lit(default))


def round_1(x: Column) -> Column:
    """Round a double to one decimal as IEEE text conversion does: on the binary value, ties to even.

    ``bround`` works on the shortest decimal text, so 0.35 (stored below 0.35) would become 0.4.
    With m = rint(20 x), the value 20 x - m is exact when computed as (16 x - m) + 4 x, and its
    sign says on which side of the tie m / 20 the stored number lies.
    """
    m = F.rint(x * 20)
    side = (x * 16 - m) + x * 4
    near_tie = (F.abs(m) % 2 == 1) & (F.abs(side) < 1e-6)
    # m is odd near a tie, so (m - 1) / 2 and (m + 1) / 2 are the neighbouring tenths
    low, high = (m - 1) / 2, (m + 1) / 2
    even = F.when(low % 2 == 0, low).otherwise(high)
    tenths = F.when(side > 0, high).when(side < 0, low).otherwise(even)
    return F.when(near_tie, tenths / 10).otherwise(F.bround(x, 1))


def text_list(values: Iterable[str]) -> Column:
    """Array literal, also when empty."""
    values = list(values)
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def title_case(name: Column) -> Column:
    return F.initcap(F.replace(name, F.lit("_"), F.lit(" ")))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first ``k`` rows of each key.

    ``row_number() <= k`` is limited per key inside every task before the shuffle, so a key that
    holds most rows still sends at most ``k`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def with_stable_id(rows: DataFrame, keys: list[str], column: str = "id") -> DataFrame:
    """Adds an id of 128 bits that follows from the values of ``keys``, unless the rows have one."""
    if column in rows.columns:
        return rows
    micros = {f.name: F.unix_micros(f"`{f.name}`") for f in rows.schema.fields if f.dataType.typeName() == "timestamp"}
    parts = [F.coalesce(micros.get(k, F.col(k)).cast("string"), F.lit("")) for k in keys]
    return rows.withColumn(column, F.md5(F.concat_ws("\n", *parts)))


def with_threat_id(threats: DataFrame, column: str = "id") -> DataFrame:
    """Adds a stable id to threats that have none: it follows from type, address and time.

    A detector that runs again gives the same threat the same id, whatever the batch or the partitioning.
    """
    return with_stable_id(threats, ["threat_type", "source_ip", "timestamp"], column)


def epoch(ts: str | Column) -> Column:
    """Whole seconds since 1970."""
    return F.unix_seconds(F.col(ts) if isinstance(ts, str) else ts)


def evaluate_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters refer to without computing them again.

    Catalyst moves a filter below a projection by repeating the projected expression in it; with
    nested regex captures the repetitions multiply.  It does not move filters below a generator, so
    a one-element ``inline`` keeps each expression to one evaluation per row.
    """
    names = list(columns)
    kept = [c for c in df.columns if c not in names]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def spread(df: DataFrame) -> DataFrame:
    """Deal out a scan that has fewer splits than the session has cores.

    A few compressed or small files would otherwise leave the parsing that follows to a few tasks.
    A scan with enough splits, the normal case for large inputs, is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

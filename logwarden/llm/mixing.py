"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden.llm.common import stored, word_count

#: 48 hash bits, looked at twelve at a time.
HASH_DIGITS, LEVEL_BITS = 12, 12
SHIFTS = (36, 24, 12, 0)


def order_hash(key: Column) -> Column:
    """The first 48 bits of the key's MD5 as a number: every source is passed through in this order."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, HASH_DIGITS), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], budget_ratio: float, max_repeats: int) -> DataFrame:
    """Targets of the sources in ``sizes`` (source, source_size): what each may give.

    The budget, ``budget_ratio`` times all sizes, is shared by weight.  A source gives ``max_repeats`` times its
    size at most, and what it cannot give goes to the others by weight until nobody is above.  That ends at a level
    at which every source gives min(limit, level x weight); sorted by limit / weight, the level follows from running
    sums.  The window has one row per source.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    limits = ranked.withColumns({"weight": weight, "_limit": F.col("source_size") * max_repeats})
    order = Window.orderBy(F.col("_limit") / F.col("weight"), "_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    level = ((F.sum("source_size").over(whole) * F.lit(float(budget_ratio)) - F.coalesce(F.sum("_limit").over(before), F.lit(0)))
             / F.sum("weight").over(after))
    # the level fits from the first source on that it does not fill
    fitting = F.min(F.when(F.col("_level") <= F.col("_limit") / F.col("weight"), F.struct("_spot", "_level"))).over(whole)
    leveled = limits.withColumns({"_level": level, "_spot": F.row_number().over(order)}).withColumn("_fit", fitting["_level"])
    target = F.coalesce(F.least(F.col("_limit").cast("double"), F.col("_fit") * F.col("weight")), F.col("_limit").cast("double"))
    return leveled.select("source", "source_size", target.alias("target"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"])


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, size) -> DataFrame:
    return stored(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), size(F.col(text_col)).cast("long").alias("size"),
        order_hash(F.col(id_col)).alias("h")), "mix-sizes")


def _limits(slim: DataFrame, weights: Sequence[float], budget_ratio: float, max_repeats: int) -> DataFrame:
    """One row per source: _key, source_size, target, full (times that all is taken), last (hash that is taken once more), more."""
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    full = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_repeats))).otherwise(0)
    sources = stored(source_targets(sizes, weights, budget_ratio, max_repeats).withColumn("full", full.cast("long"))
                     .withColumn("budget", F.col("target") - F.col("full") * F.col("source_size")), "mix-sources")
    # known of each threshold so far: its leading bits and the sizes before them
    cut = sources.select("source", "budget", F.lit(0).cast("long").alias("lead"), F.lit(0).cast("long").alias("base"),
                         F.lit(0).cast("long").alias("reached"))
    for shift in SHIFTS:
        inside = slim.join(cut, _same(slim, cut)).where(F.shiftright(slim["h"], shift + LEVEL_BITS) == cut["lead"])
        histogram = inside.groupBy(cut["source"].alias("source"), "budget", "base", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("n"))
        running = F.col("base") + F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
        past = histogram.withColumn("reached", running).where("reached > budget")
        first = past.groupBy("source").agg(F.min(F.struct("bucket", "reached", "n", "budget")).alias("b"))
        cut = stored(first.select(
            "source", F.col("b.budget").alias("budget"), F.col("b.bucket").alias("lead"),
            (F.col("b.reached") - F.col("b.n")).alias("base"), F.col("b.reached").alias("reached")), "mix-cut")
    nearer = (F.col("reached") - F.col("budget")) < (F.col("budget") - F.col("base"))
    threshold = cut.select(F.col("source").alias("_source"), F.when(nearer, F.col("lead")).otherwise(F.col("lead") - 1).alias("last"))
    limits = sources.join(threshold, sources["source"].eqNullSafe(threshold["_source"]), "left").select(
        F.col("source").alias("_key"), "source_size", "target", "full", "last", (F.col("budget") > 0).alias("more"))
    return stored(limits, "mix-limits")


def _repeats(h: Column, limit, max_repeats: int) -> Column:
    """How often a row of order hash ``h`` is taken; ``limit`` names the columns of its source's limits."""
    # no boundary: the whole source fits into its budget
    extra = F.when(limit("more") & (limit("last").isNull() | (h <= limit("last"))), 1).otherwise(0)
    return F.least(limit("full") + extra, F.lit(max_repeats)).cast("long")


def mix_sources(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget_ratio: float = 1.5, max_repeats: int = 2,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", size=word_count) -> DataFrame:
    """One row per document: id, size, source, source_size, target, repeats and taken (repeats x size).

    Weights go to the sources in code point order, null last, and repeat.  A target of r times the source's size
    takes every document floor(r) times; what is left is a budget that documents fill in the order of a hash of
    their id, so a smaller budget always takes a part of what a larger one takes.  The threshold is the hash at
    which the running sum of sizes passes the budget; it is found with a histogram of 4,096 hash buckets per source,
    of whose buckets only the one that holds the boundary is cut into 4,096 again, down to single hashes.  The
    document at the boundary is taken when that brings the sum nearer to the budget.  Nothing is sorted; the last
    filter compares a hash with its source's threshold.

    A null text or source is an empty text and a source of its own; a null id hashes as an empty string.  Rows with
    the same id are taken together.  An empty table gives an empty result.
    """
    slim = _sized(docs, id_col, text_col, source_col, size)
    limits = _limits(slim, weights, budget_ratio, max_repeats)
    joined = slim.join(limits, slim["source"].eqNullSafe(limits["_key"]))
    repeats = _repeats(F.col("h"), F.col, max_repeats)
    return joined.select(
        F.col("id").alias(id_col), "size", F.col("source").alias(source_col), "source_size", "target",
        repeats.alias("repeats"), (repeats * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), budget_ratio: float = 1.5, max_repeats: int = 2,
               id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", size=word_count) -> DataFrame:
    """The mix itself: rows of ``docs`` as :func:`mix_sources` takes them, with all their columns, repeated where it repeats.

    A row's hash is compared with its source's limits where the row is read, so texts meet a table of one row per
    source and are not exchanged for their ids.  Rows with one id in several sources follow each its own source.
    """
    limits = _limits(_sized(docs, id_col, text_col, source_col, size), weights, budget_ratio, max_repeats)
    packed = limits.select(F.struct("*").alias("limit"))
    joined = docs.join(packed, docs[source_col].eqNullSafe(packed["limit"]["_key"]))
    repeats = _repeats(order_hash(docs[id_col]), lambda name: packed["limit"][name], max_repeats)
    time = "_time"
    while time in docs.columns:
        time += "_"
    return joined.select(*[docs[f"`{c}`"] for c in docs.columns], F.explode(F.array_repeat(F.lit(1), repeats.cast("int"))).alias(time)).drop(time)

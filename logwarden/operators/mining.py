"""Association rules over sets of items."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import as_of_col, before, operator
from logwarden.session import checkpoint_dir


def _transactions(threats: DataFrame, unit: str, as_of, hours: int) -> DataFrame:
    time = F.coalesce("timestamp", "ingested_at")
    kind = F.trim("threat_type")
    cutoff = before(as_of_col(threats, as_of), max(1, hours) * 3600)
    return (
        threats.where((time >= cutoff) & (kind != ""))
        .groupBy(F.date_trunc(unit, time).alias("bucket"))
        .agg(F.sort_array(F.collect_set(kind)).alias("items"))
    )


@operator
def rules_tx_hour(threats: DataFrame, as_of=None, hours: int = 168) -> DataFrame:
    """(bucket, items): the different threat types of each UTC hour."""
    return _transactions(threats, "hour", as_of, hours)


@operator
def rules_tx_day(threats: DataFrame, as_of=None, hours: int = 168) -> DataFrame:
    return _transactions(threats, "day", as_of, hours)


@operator
def rules_auto_bucket(threats: DataFrame, as_of=None, hours: int = 168) -> DataFrame:
    """Hourly transactions, or daily ones if no hour has two types; ``bucket_used`` tells which.

    The choice is a scalar subquery of the same plan, and both kinds come from one set of hourly
    types, so nothing runs twice or ahead of time.
    """
    hourly = rules_tx_hour(threats, as_of, hours)
    multi = hourly.agg(F.coalesce(F.max(F.size("items")), F.lit(0)) >= 2).scalar()
    unit = F.when(multi, "hour").otherwise("day")
    grouped = hourly.select(
        unit.alias("bucket_used"), F.when(multi, F.col("bucket")).otherwise(F.date_trunc("day", "bucket")).alias("bucket"), "items"
    )
    return grouped.groupBy("bucket_used", "bucket").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )


def default_min_support(n: Column, kind: str = "threats") -> Column:
    low, high, rows = (0.02, 0.5, 2.0) if kind == "threats" else (0.05, 0.25, 3.0)
    return F.greatest(F.lit(low), F.least(F.lit(high), F.lit(rows) / n))


@operator
def rules_min_support_default(transactions: DataFrame, kind: str = "threats") -> DataFrame:
    n = F.count("*")
    return transactions.agg(n.alias("n"), default_min_support(n, kind).alias("min_support"))


def _weighted(transactions: DataFrame) -> DataFrame:
    """Different item sets with how often each occurs: everything below works on these.

    They are few, used several times, and their input may be large, so they are checkpointed.
    """
    checkpoint_dir(transactions.sparkSession)
    return (
        transactions.select(F.array_sort(F.array_distinct("items")).alias("items"))
        .groupBy("items")
        .agg(F.count("*").alias("weight"))
        .checkpoint()
    )


@operator
def rules_itemsets(transactions: DataFrame, min_support: float | None = None, kind: str = "threats") -> DataFrame:
    """(items, freq, n, support) of all frequent itemsets; ``transactions`` has ``items``.

    Equal transactions are counted once with a weight, and items that are not frequent are removed.  Sets then grow by
    one item a level: each frequent set keeps what follows it in its transactions, and equal remainders are merged with
    their weights.  So the rows of a level are at most the frequent sets of that size times their different remainders,
    however wide a transaction is.  Levels are checkpointed; the loop ends at the size of the largest frequent set.
    """
    weighted = _weighted(transactions)
    n = weighted.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("n")).first()["n"]
    if not n:
        return weighted.select("items", F.lit(0).cast("bigint").alias("freq"), F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("support")).limit(0)
    least = default_min_support(F.lit(n), kind) if min_support is None else F.lit(float(min_support))
    enough = F.col("freq") / F.lit(n) >= least
    single = weighted.select(F.explode("items").alias("item"), "weight").groupBy("item").agg(F.sum("weight").alias("freq")).where(enough)
    frequent = single.agg(F.collect_list("item")).scalar()  # at most 1 / support items per width
    rest = weighted.select(F.array().cast(weighted.schema["items"].dataType).alias("items"), F.array_intersect("items", frequent).alias("rest"), "weight")
    found = []
    while True:
        longer = rest.select("items", F.posexplode("rest").alias("at", "item"), "rest", "weight").select(
            F.array_append("items", F.col("item")).alias("items"), F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"), "weight")
        groups = longer.groupBy("items", "rest").agg(F.sum("weight").alias("weight")).checkpoint()
        counts = groups.groupBy("items").agg(F.sum("weight").alias("freq")).where(enough)
        found.append(counts)
        if len(found) > 1 and counts.isEmpty():
            break
        rest = groups.where(F.size("rest") > 0).join(counts, "items", "left_semi")
        if rest.isEmpty():
            break
    counted = functools.reduce(DataFrame.unionByName, found)
    return counted.withColumns({"n": F.lit(n).cast("bigint"), "support": F.col("freq") / F.lit(n)})


@operator
def rules_association(
    itemsets: DataFrame, min_confidence: float = 0.35, max_rules: int | None = None, order: tuple[str, ...] = ("confidence", "support")
) -> DataFrame:
    """Every split of each itemset into antecedents and consequents with enough confidence.

    Works on the itemsets alone: each side of a split is frequent too, so its count is looked up among them.
    Consequents grow by one item a level, and only from those with enough confidence: taking more items away from the
    antecedents can only lower it.
    """
    checkpoint_dir(itemsets.sparkSession)
    sets = itemsets.where(F.size("items") >= 2).select("items", "support")
    known = itemsets.select("items", "support")
    lift = known.select(F.col("items").alias("consequents"), F.col("support").alias("_c"))
    none = F.array().cast(itemsets.schema["items"].dataType)
    grown = sets.select("items", "support", none.alias("consequents"), F.lit(-1).alias("at"))
    found = []
    while True:
        longer = grown.where(F.size("consequents") + 1 < F.size("items")).select(
            "items", "support", "consequents", "at", F.posexplode("items").alias("next", "item")).where(F.col("next") > F.col("at"))
        longer = longer.select("items", "support", F.array_append("consequents", F.col("item")).alias("consequents"), F.col("next").alias("at"))
        longer = longer.withColumn("antecedents", F.array_except("items", "consequents"))
        joined = longer.join(known.select(F.col("items").alias("antecedents"), F.col("support").alias("_a")), "antecedents")
        passing = joined.withColumn("confidence", F.col("support") / F.col("_a")).where(F.col("confidence") >= min_confidence)
        grown = passing.drop("_a").checkpoint()
        found.append(grown)
        if grown.where(F.size("consequents") + 1 < F.size("items")).isEmpty():
            break
    rules_found = functools.reduce(DataFrame.unionByName, found).join(lift, "consequents").select(
        "antecedents", "consequents", "support", "confidence", (F.col("confidence") / F.col("_c")).alias("lift"))
    ordered = rules_found.orderBy(*[F.desc(c) for c in order], "antecedents", "consequents")
    return ordered if max_rules is None else ordered.limit(max_rules)


@operator
def rules_pairwise(
    transactions: DataFrame, min_support: float | None = None, min_confidence: float = 0.35, max_rules: int | None = None
) -> DataFrame:
    """Two-item rules from all pairs with enough support, in both directions; of two directions with equal
    confidence only the first is kept, as published (where 30 rules are shown)."""
    weighted = _weighted(transactions)
    n = weighted.agg(F.coalesce(F.sum("weight"), F.lit(0))).scalar()
    least = default_min_support(n) if min_support is None else F.lit(float(min_support))
    items = weighted.select(F.explode("items").alias("item"), "weight").groupBy("item").agg(F.sum("weight").alias("c"))
    # item types per transaction are few, and equal transactions are already one row
    rest = weighted.select(F.posexplode("items").alias("i", "a"), "items", "weight")
    pairs = (
        rest.select("a", F.explode(F.slice("items", F.col("i") + 2, F.size("items"))).alias("b"), "weight")
        .groupBy("a", "b").agg(F.sum("weight").alias("c")).where(F.col("c") / n >= least)
    )
    both = pairs.join(items.select(F.col("item").alias("a"), F.col("c").alias("ca")), "a").join(
        items.select(F.col("item").alias("b"), F.col("c").alias("cb")), "b"
    )
    ab, ba = F.col("c") / F.col("ca"), F.col("c") / F.col("cb")
    forward = F.struct(F.col("a").alias("antecedent"), F.col("b").alias("consequent"), ab.alias("confidence"), (ab / (F.col("cb") / n)).alias("lift"))
    back = F.struct(F.col("b").alias("antecedent"), F.col("a").alias("consequent"), ba.alias("confidence"), (ba / (F.col("ca") / n)).alias("lift"))
    rows = both.select((F.col("c") / n).alias("support"), F.inline(F.array_compact(F.array(forward, F.when(ba != ab, back)))))
    ordered = rows.where(F.col("confidence") >= min_confidence).orderBy(F.desc("confidence"), F.desc("support"), "antecedent", "consequent")
    return ordered if max_rules is None else ordered.limit(max_rules)


# --- binned flows ---------------------------------------------------------------------


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], accuracy: int = 10_000) -> dict[str, list[float]]:
    """Linearly interpolated quantiles of several columns, as pandas gives them.

    Exact percentiles in one aggregate would hold every different value in one task.  Here a sketch
    brackets each wanted rank; a second pass counts what lies below the bracket and groups only the
    values inside it, a few ten-thousandths of the data.
    """
    margin = 2.0 / accuracy
    marks = sorted({min(1.0, max(0.0, p + s)) for p in probabilities for s in (-margin, margin)})
    sketch = df.agg(
        *[F.percentile_approx(c, marks, accuracy).alias(f"q{i}") for i, c in enumerate(columns)],
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.min(c).alias(f"lo{i}") for i, c in enumerate(columns)],
        *[F.max(c).alias(f"hi{i}") for i, c in enumerate(columns)],
    ).first()
    # (index, probability index, rank, low, high)
    wanted, below, inside = [], [], []
    for i, c in enumerate(columns):
        n = sketch[f"n{i}"]
        for j, p in enumerate(probabilities):
            if n == 0:
                continue
            rank = p * (n - 1)
            low = sketch[f"lo{i}"] if p - margin <= 0 else sketch[f"q{i}"][marks.index(p - margin)]
            high = sketch[f"hi{i}"] if p + margin >= 1 else sketch[f"q{i}"][marks.index(p + margin)]
            key = f"{i}_{j}"
            wanted.append((key, i, j, rank))
            below.append(F.count_if(F.col(f"`{c}`") < low).alias(key))
            inside.append(F.when(F.col(f"`{c}`").between(low, high), F.struct(F.lit(key).alias("key"), F.col(f"`{c}`").alias("v"))))
    if not wanted:
        return {c: [] for c in columns}
    under = df.agg(*below).first()
    values = df.select(F.inline(F.array_compact(F.array(*inside)))).groupBy("key", "v").agg(F.count("*").alias("n"))
    from pyspark.sql import Window

    upto = F.sum("n").over(Window.partitionBy("key").orderBy("v"))
    place = None
    for key, _, _, rank in wanted:
        first = int(rank) - under[key]
        hit = F.struct(F.lit(float(first)).alias("a"), F.lit(float(first + 1)).alias("b"))
        place = F.when(F.col("key") == key, hit) if place is None else place.when(F.col("key") == key, hit)
    ranked = values.withColumn("upto", upto).withColumn("w", place)
    picked = {
        r["key"]: (r["a"], r["b"])
        for r in ranked.groupBy("key").agg(
            F.min(F.when(F.col("upto") > F.col("w.a"), F.col("v"))).alias("a"),
            F.min(F.when(F.col("upto") > F.col("w.b"), F.col("v"))).alias("b"),
        ).collect()  # one row per column and probability
    }
    result: dict[str, list[float]] = {c: [] for c in columns}
    for key, i, _, rank in wanted:
        a, b = picked[key]
        share = rank - int(rank)
        result[columns[i]].append(float(a) if share == 0 or b is None else float(a) + (float(b) - float(a)) * share)
    return result


def fit_flow_bins(flows: DataFrame, features: list[str]) -> dict[str, tuple[list[float], list[str]]]:
    """Inner edges and labels per feature: thirds, or halves if edges repeat; features with repeated
    halves or one value are left out."""
    quantiles = exact_quantiles(flows, features, [0.0, 1 / 3, 0.5, 2 / 3, 1.0])
    bins = {}
    for feature, q in quantiles.items():
        if not q or q[0] == q[4]:
            continue
        for edges, labels in (([q[0], q[1], q[3], q[4]], ["lo", "mid", "hi"]), ([q[0], q[2], q[4]], ["lo", "hi"])):
            if len(set(edges)) == len(edges):
                bins[feature] = (edges[1:-1], labels)
                break
    return bins


@operator
def rules_flow_bins(flows: DataFrame, features: list[str], bins=None) -> DataFrame:
    """Adds ``items``: one binned item per usable feature (right-closed bins) and the outcome."""
    bins = fit_flow_bins(flows, features) if bins is None else bins
    items = []
    for feature, (edges, labels) in bins.items():
        column, value = None, F.col(f"`{feature}`")
        for edge, label in zip(edges, labels):
            text = F.lit(f"{feature.replace(' ', '_')}={label}")
            column = F.when(value <= edge, text) if column is None else column.when(value <= edge, text)
        items.append(column.otherwise(F.lit(f"{feature.replace(' ', '_')}={labels[-1]}")))
    outcome = F.when(F.col("is_attack") == 1, "outcome_attack").otherwise("outcome_normal")
    return flows.withColumn("items", F.array(*items, outcome))


@operator
def rules_flow(
    flows: DataFrame, features: list[str], max_features: int | None = None, min_support: float | None = None, min_confidence: float = 0.5,
    max_rules: int | None = None,
) -> DataFrame:
    """Rules between binned features and the outcome, by lift and confidence.

    All ``features`` count; the published report takes the first 8 and shows 25 rules.
    """
    binned = rules_flow_bins(flows, features[:max_features])
    itemsets = rules_itemsets(binned.select("items"), min_support, kind="flows")
    return rules_association(itemsets, min_confidence, max_rules, order=("lift", "confidence"))

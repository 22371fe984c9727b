"""Which threats raise alerts, and what suppresses them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import operator, text_list
from logwarden.functions import scoring
from logwarden.operators.enrich import contains_join


@operator
def alert_candidates(threats: DataFrame, policy: str = "full", threshold: float = rules.ALERT_THRESHOLD) -> DataFrame:
    """Threats worth an alert: by score only (``short``), or also by level and type (``full``)."""
    by_score = F.col("risk_score") >= threshold
    if policy == "short":
        return threats.where(by_score)
    level = F.col("risk_level") if "risk_level" in threats.columns else scoring.band(F.col("risk_score"))
    urgent_type = F.col("threat_type").isin("brute_force", "suspicious_pattern") & (F.col("risk_score") >= 5.0)
    return threats.where(level.isin("CRITICAL", "HIGH") | by_score | urgent_type)


@operator
def alert_rules_eval(threats: DataFrame, rule_table: DataFrame) -> DataFrame:
    """How many threats each active rule matches and whether it fires.

    ``risk_threshold`` rules ask for a minimum score, ``pattern_match`` rules for a number of threats
    of one type.  Threats are first counted per (type, score).  Scores and minimum scores are then put in order within
    thousandths of a point and added up from above, and the sums of whole thousandths likewise: a step function of
    the score, read at each rule's minimum, so rules and scores never meet in pairs.
    """
    histogram = threats.groupBy("threat_type", "risk_score").agg(F.count("*").alias("n"), F.max("timestamp").alias("last"))
    conditions = F.from_json("conditions", "min_risk_score double, pattern_type string, min_occurrences bigint")
    active = rule_table.where("is_active").withColumn("_c", conditions)
    least = F.col("_c.min_risk_score")
    asked = active.where((F.col("rule_type") == "risk_threshold") & least.isNotNull()).select(
        "name", least.alias("score"), F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("timestamp").alias("last"))
    counted = histogram.where(F.col("risk_score").isNotNull()).select(
        F.lit(None).cast("string").alias("name"), F.col("risk_score").alias("score"), "n", F.col("last").cast("timestamp").alias("last"))
    # scores run from 0 to 10; what lies outside shares the first and the last thousandth
    block = F.floor(F.least(F.greatest(F.col("score"), F.lit(-1.0)), F.lit(11.0)) * 1000).cast("int")
    steps = counted.unionByName(asked).withColumn("_block", block)
    downward = Window.partitionBy("_block").orderBy(F.desc("score")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    within = steps.withColumns({"n": F.sum("n").over(downward), "last": F.max("last").over(downward)}).where("name IS NOT NULL")
    higher = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)  # over at most 12,001 rows
    above = steps.groupBy("_block").agg(F.sum("n").alias("_n"), F.max("last").alias("_last")).select(
        "_block", F.coalesce(F.sum("_n").over(higher), F.lit(0)).alias("_above"), F.max("_last").over(higher).alias("_last"))
    by_score = within.join(F.broadcast(above), "_block").select("name", (F.col("n") + F.col("_above")).alias("n"), F.greatest("last", "_last").alias("last"))
    type_rules = active.where(F.col("rule_type") == "pattern_match").select("name", F.col("_c.pattern_type").alias("threat_type"))
    per_type = histogram.groupBy("threat_type").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    by_type = per_type.join(type_rules, "threat_type")
    matched = (
        by_score.select("name", "n", "last").unionByName(by_type.select("name", "n", "last"))
        .groupBy("name").agg(F.sum("n").alias("n"), F.max("last").alias("last_match"))
    )
    matches = F.coalesce("n", F.lit(0))
    return active.join(matched, "name", "left").select(
        "name", "rule_type", "severity_threshold", matches.alias("matches"), "last_match",
        (matches >= F.coalesce(F.col("_c.min_occurrences"), F.lit(1))).alias("triggered"),
    )


@operator
def alert_suppress(alerts: DataFrame, suppress: DataFrame) -> DataFrame:
    """Drop alerts under an active suppression of their address (``ip``), their type (``type``) or a
    part of their description (``pattern``) at their time."""
    active = suppress.where("is_active").select("suppression_type", "match_value", "created_at", "expires_at")
    in_time = F.col("timestamp").between(F.col("created_at"), F.col("expires_at"))
    kept = alerts
    for kind, column in (("ip", "source_ip"), ("type", "threat_type")):
        rows = active.where(F.col("suppression_type") == kind).drop("suppression_type")
        kept = kept.join(rows, (F.col(column) == F.col("match_value")) & in_time, "left_anti")
    parts = active.where(F.col("suppression_type") == "pattern").drop("suppression_type")
    hit = contains_join(kept.select("id", "description", "timestamp"), "description", parts, "match_value").where(in_time)
    return kept.join(hit.select("id").distinct(), "id", "left_anti").select(*alerts.columns)


@operator
def alert_summary(threats: DataFrame) -> DataFrame:
    """One long table (section, position, key, n, score): types by count, levels in fixed order, top
    five addresses, first three critical threats (by time) and top five threats by score."""
    leveled = threats if "risk_level" in threats.columns else threats.withColumn("risk_level", scoring.band(F.col("risk_score")))
    no_score, one = F.lit(None).cast("double"), F.lit(1).cast("bigint")

    def counts(column: str) -> DataFrame:
        return leveled.groupBy(F.coalesce(column, F.lit("unknown")).alias("key")).agg(F.count("*").alias("n")).withColumn(
            "score", no_score)

    def section(name: str, rows: DataFrame, *order) -> DataFrame:
        # rows are few here: one per type, level or listed threat
        position = F.row_number().over(Window.partitionBy(F.lit(name)).orderBy(*order))
        return rows.select(F.lit(name).alias("section"), position.cast("bigint").alias("position"), "key", "n", "score")

    levels = [label for _, label in rules.BANDS["risk"]][:4]
    in_order = F.array_position(text_list(levels), F.col("key"))
    listed = leveled.select(
        F.concat_ws(" from ", "threat_type", "source_ip").alias("key"), one.alias("n"), F.col("risk_score").alias("score"),
        "timestamp", "id", "risk_level",
    )
    critical = listed.where("risk_level = 'CRITICAL'").orderBy("timestamp", "id").limit(3)
    worst = listed.orderBy(F.desc("score"), "id").limit(5)
    parts = [
        section("type", counts("threat_type"), F.desc("n"), F.asc("key")),
        section("level", counts("risk_level").where(F.col("key").isin(levels)), in_order),
        section("top_ip", counts("source_ip").orderBy(F.desc("n"), "key").limit(5), F.desc("n"), F.asc("key")),
        section("critical", critical, F.asc("timestamp"), F.asc("id")),
        section("top_score", worst, F.desc("score"), F.asc("id")),
    ]
    return reduce(DataFrame.unionByName, parts)

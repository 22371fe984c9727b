"""Counts, top lists, heatmaps and timelines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import as_of_col, before, ladder, operator, title_case
from logwarden.functions import scoring
from logwarden.operators.search import is_recent


def _long(df: DataFrame, section: str) -> DataFrame:
    """One row of named numbers as (section, key, n) rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("bigint").alias("n")) for c in df.columns])
    return df.select(F.lit(section).alias("section"), F.inline(pairs))


def _count_if(condition: Column) -> Column:
    return F.count_if(condition)


@operator
def system_stats(
    threats: DataFrame, logs: DataFrame | None = None, alerts: DataFrame | None = None, as_of=None, window_s: int = 86400
) -> DataFrame:
    """(section, key, n): totals, recent rows, active threats, alerts sent, threats by type.

    One pass per table.
    """
    cutoff = before(as_of_col(threats, as_of), window_s)
    by_type = threats.groupBy(F.coalesce("threat_type", F.lit("unknown")).alias("key")).agg(F.count("*").alias("n"))
    parts = [
        _long(
            threats.agg(
                F.count("*").alias("total_threats"),
                _count_if(F.col("status") == "active").alias("active_threats"),
                _count_if(is_recent(cutoff)).alias("recent_threats"),
            ),
            "threats",
        ),
        by_type.select(F.lit("threats_by_type").alias("section"), "key", "n"),
    ]
    if logs is not None:
        parts.append(_long(logs.agg(F.count("*").alias("total_logs"), _count_if(is_recent(cutoff)).alias("recent_logs")), "logs"))
    if alerts is not None:
        parts.append(_long(alerts.agg(_count_if(F.col("sent") == "yes").alias("alerts_sent")), "alerts"))
    return reduce(DataFrame.unionByName, parts)


@operator
def dashboard_snapshot(
    threats: DataFrame, logs: DataFrame, as_of=None, minutes: int = 60, n_threats: int = 20, n_logs: int = 10
) -> DataFrame:
    """:func:`system_stats` of the last minutes plus the latest threats and log lines (cut to 200
    characters for display), as (section, key, n, text, timestamp)."""
    stats = system_stats(threats, logs, as_of=as_of, window_s=minutes * 60).withColumns(
        {"text": F.lit(None).cast("string"), "timestamp": F.lit(None).cast("timestamp")}
    )

    def latest(df: DataFrame, section: str, n: int, text: Column) -> DataFrame:
        rows = df.orderBy(F.desc("timestamp"), F.desc("id")).limit(n)
        return rows.select(
            F.lit(section).alias("section"), F.col("source_ip").alias("key"), F.col("id").cast("bigint").alias("n"),
            text.alias("text"), "timestamp",
        )

    return (
        stats.unionByName(latest(threats, "latest_threats", n_threats, F.col("description")))
        .unionByName(latest(logs, "latest_logs", n_logs, F.substring("raw_log", 1, 200)))
    )


@operator
def top_threat_types(threats: DataFrame, limit: int = 5) -> DataFrame:
    return (
        threats.groupBy("threat_type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "threat_type").limit(limit)
    )


@operator
def top_source_ips(threats: DataFrame, limit: int = 5) -> DataFrame:
    return (
        threats.groupBy("source_ip")
        .agg(F.count("*").alias("n"), F.max("risk_score").alias("max_score"))
        .orderBy(F.desc("n"), "source_ip")
        .limit(limit)
    )


@operator
def highest_and_latest_threat(threats: DataFrame) -> DataFrame:
    """(section, id, threat_type, source_ip, risk_score, status, timestamp) of the highest, the
    latest and the latest active threat, found by aggregation in one pass."""
    row = F.struct("id", "threat_type", "source_ip", "risk_score", "status", "timestamp")
    neg = -F.col("id")
    active = F.col("status") == "active"
    best = threats.agg(
        F.max_by(row, F.struct("risk_score", neg)).alias("highest"),
        F.max_by(row, F.struct("timestamp", "id")).alias("latest"),
        F.max_by(row, F.when(active, F.struct("risk_score", neg))).alias("highest_active"),
        F.max_by(row, F.when(active, F.struct("timestamp", "id"))).alias("latest_active"),
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("section"), F.col(c).alias("row")) for c in best.columns])
    return best.select(F.inline(pairs)).where("row IS NOT NULL").select("section", "row.*")


@operator
def risk_threshold_counts(threats: DataFrame) -> DataFrame:
    return threats.agg(
        _count_if(F.col("risk_score") >= 7.0).alias("high"), _count_if(F.col("risk_score") >= 9.0).alias("critical")
    )


@operator
def executive_summary(threats: DataFrame, logs: DataFrame) -> DataFrame:
    """(section, key, n, share): totals, threats per level and per type with their share in percent."""
    level = scoring.band(F.col("risk_score"))
    counts = threats.groupBy("threat_type", level.alias("level"), "status").agg(F.count("*").alias("n"))
    no_share = F.lit(None).cast("double")

    def one(section: str, key: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(section).alias("section"), F.lit(key).alias("key"), F.coalesce("n", F.lit(0)).alias("n"), no_share.alias("share"))

    total = counts.agg(F.sum("n")).scalar()
    by_type = counts.groupBy(F.col("threat_type").alias("key")).agg(F.sum("n").alias("n"))
    by_level = counts.groupBy(F.col("level").alias("key")).agg(F.sum("n").alias("n"))
    parts = [
        one("total", "logs", logs.agg(F.count("*").alias("n"))),
        one("total", "threats", counts.agg(F.sum("n").alias("n"))),
        one("total", "active", counts.where("status = 'active'").agg(F.sum("n").alias("n"))),
        one("total", "resolved", counts.where("status = 'resolved'").agg(F.sum("n").alias("n"))),
        by_level.select(F.lit("level").alias("section"), "key", "n", no_share.alias("share")),
        by_type.select(F.lit("type").alias("section"), "key", "n", F.bround(F.col("n") / total * 100, 1).alias("share")),
    ]
    return reduce(DataFrame.unionByName, parts)


@operator
def executive_list(threats: DataFrame) -> DataFrame:
    """All threats of the report, newest first, with their level."""
    return threats.withColumn("risk_level", scoring.band(F.col("risk_score"))).orderBy(F.desc("timestamp"), F.desc("id"))


@operator
def risk_level_distribution(threats: DataFrame, scale: str = "risk") -> DataFrame:
    return threats.groupBy(scoring.band(F.col("risk_score"), scale).alias("risk_level")).agg(F.count("*").alias("n"))


@operator
def attack_timeline(threats: DataFrame, incidents: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """Threats and incidents of the last hours in one list, oldest first.

    A threat counts at its event time if that is in the window, else at its ingest time.
    """
    cutoff = before(as_of_col(threats, as_of), hours * 3600)
    effective = F.when(F.col("timestamp") >= cutoff, F.col("timestamp")).otherwise(F.col("ingested_at"))
    severity = F.lower(F.coalesce("severity", F.lit("medium")))
    events = threats.where(is_recent(cutoff)).select(
        effective.alias("timestamp"),
        F.lit("threat").alias("type"),
        F.concat(F.lit("Threat: "), F.coalesce("threat_type", F.lit("unknown"))).alias("title"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce(scoring.band(F.col("risk_score"), "timeline"), F.lit("low")).alias("severity"),
        "source_ip",
        F.lit(None).cast("string").alias("status"),
        F.col("id").cast("string").alias("id"),
    )
    cases = incidents.where(F.col("created_at") >= cutoff).select(
        F.col("created_at").alias("timestamp"),
        F.lit("incident").alias("type"),
        F.concat(F.lit("Incident: "), "title").alias("title"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.when(severity.isin("low", "medium", "high", "critical"), severity).otherwise("medium").alias("severity"),
        F.lit(None).cast("string").alias("source_ip"),
        "status",
        F.col("incident_id").alias("id"),
    )
    return events.unionByName(cases).orderBy("timestamp", "type", "id")


DAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


@operator
def attack_heatmap(threats: DataFrame) -> DataFrame:
    """(section, slot, label, n, is_peak): threats per hour 0-23 and weekday 0-6 (Sunday = 0), with
    zeros; the peak is the first slot with the highest count."""
    counts = threats.groupBy(F.hour("timestamp").alias("hour"), (F.dayofweek("timestamp") - 1).alias("day")).agg(
        F.count("*").alias("n"))
    spark = threats.sparkSession

    def filled(section: str, slots: int, label: Column) -> DataFrame:
        n = counts.groupBy(F.col(section).cast("bigint").alias("slot")).agg(F.sum("n").alias("n"))
        rows = spark.range(slots).withColumnRenamed("id", "slot").join(n, "slot", "left").select(
            F.lit(section).alias("section"), "slot", label.alias("label"), F.coalesce("n", F.lit(0)).alias("n"))
        peak = Window.partitionBy("section").orderBy(F.desc("n"), "slot")
        return rows.withColumn("is_peak", F.row_number().over(peak) == 1)

    day_label = F.element_at(F.array(*map(F.lit, DAYS)), (F.col("slot") + 1).cast("int"))
    return filled("hour", 24, F.col("slot").cast("string")).unionByName(filled("day", 7, day_label))


def technique_table(spark) -> DataFrame:
    return spark.createDataFrame(rules.MITRE_TECHNIQUES, "threat_type string, technique_id string, technique string, tactic string")


@operator
def mitre_heatmap(threats: DataFrame, techniques: DataFrame | None = None) -> DataFrame:
    """Hits per threat type with its technique; techniques whose id was not hit are added with zero."""
    table = technique_table(threats.sparkSession) if techniques is None else techniques
    per_type = threats.groupBy("threat_type").agg(F.count("*").alias("count"), F.max("risk_score").alias("top"))
    severity = ladder(F.coalesce("top", F.lit(0.0)), [(9.0, "critical"), (7.0, "high"), (4.0, "medium"), (None, "low")])
    hit = per_type.join(table, "threat_type", "left").select(
        "threat_type",
        F.coalesce("technique_id", F.lit("T????")).alias("technique_id"),
        F.coalesce("technique", title_case(F.col("threat_type"))).alias("technique"),
        F.coalesce("tactic", F.lit("Unknown")).alias("tactic"),
        "count",
        F.coalesce(F.bround("top", 1), F.lit(0.0)).alias("max_score"),
        severity.alias("severity"),
    )
    missed = table.join(hit.select("technique_id"), "technique_id", "left_anti").select(
        "threat_type", "technique_id", "technique", "tactic", F.lit(0).cast("bigint").alias("count"),
        F.lit(0.0).alias("max_score"), F.lit("none").alias("severity"),
    )
    return hit.unionByName(missed)


@operator
def retention_report(logs: DataFrame, as_of=None, days: int = 90) -> DataFrame:
    """Addresses are counted after a grouping by address, so no task holds the set of them."""
    old = F.col("timestamp") < before(as_of_col(logs, as_of), days * 86400)
    per_ip = logs.groupBy("source_ip").agg(F.count("*").alias("n"), _count_if(old).alias("old"))
    return per_ip.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_logs"),
        F.coalesce(F.sum("old"), F.lit(0)).alias("old_logs"),
        F.count("source_ip").alias("unique_ips"),
    ).withColumn("compliant", F.col("old_logs") == 0)


@operator
def logs_per_second(logs: DataFrame, as_of=None) -> DataFrame:
    """Rate over the last minute."""
    start = before(as_of_col(logs, as_of), 60)
    return logs.where(F.col("timestamp") >= start).agg(F.bround(F.count("*") / 60, 2).alias("logs_per_second"))


@operator
def logs_per_second_by_minute(logs: DataFrame) -> DataFrame:
    return logs.groupBy(F.window("timestamp", "1 minute").alias("w")).agg(F.count("*").alias("n")).select(
        F.col("w.start").alias("minute"), "n", F.bround(F.col("n") / 60, 2).alias("logs_per_second"))

"""Filters, search, de-duplication and status changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import as_of_col, before, first_per_key, operator
from logwarden.functions import parsing, scoring
from logwarden.operators.enrich import geo_enrich


def _matching(logs: DataFrame, text, source_ip, start, end, action) -> DataFrame:
    if text:
        logs = logs.where(F.col("raw_log").ilike(f"%{text}%"))
    if source_ip:
        logs = logs.where(F.col("source_ip").ilike(f"%{source_ip}%"))
    if start is not None:
        logs = logs.where(F.col("timestamp") >= F.lit(start).cast("timestamp"))
    if end is not None:
        logs = logs.where(F.col("timestamp") <= F.lit(end).cast("timestamp"))
    if action:
        logs = logs.where(F.col("action") == action)
    return logs


@operator
def log_search(
    logs: DataFrame, text=None, source_ip=None, start=None, end=None, action=None, limit: int = 50, offset: int = 0
) -> DataFrame:
    """One page of the matching entries, newest first, each row with the total number of matches."""
    found = _matching(logs, text, source_ip, start, end, action)
    total = found.agg(F.count("*")).scalar()
    page = found.orderBy(F.desc("timestamp"), F.desc("id")).offset(offset).limit(limit)
    return page.select("id", "timestamp", "source_ip", "destination_port", "protocol", "action", "raw_log", total.alias("total"))


def _dedup(logs: DataFrame, keys: list[str], store: DataFrame | None) -> DataFrame:
    """Lowest id per key, then without the keys already stored.  Copies of a key are reduced to one
    per task before they are brought together."""
    kept = first_per_key(logs, keys, [F.asc("id")])
    if store is None:
        return kept
    known = store.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = None
    for k in keys:
        equal = F.col(k).eqNullSafe(F.col(f"_{k}"))
        same = equal if same is None else same & equal
    return kept.join(known, same, "left_anti")


@operator
def log_dedup_exact(logs: DataFrame, store: DataFrame | None = None) -> DataFrame:
    return _dedup(logs, ["source_ip", "timestamp", "raw_log"], store)


@operator
def log_dedup_content(logs: DataFrame, store: DataFrame | None = None) -> DataFrame:
    return _dedup(logs, ["source_ip", "raw_log"], store)


def is_recent(cutoff: Column) -> Column:
    """Event time or ingest time at or after the cutoff."""
    return (F.col("timestamp") >= cutoff) | (F.col("ingested_at") >= cutoff)


@operator
def recent_window_count(df: DataFrame, as_of=None, window_s: int = 86400) -> DataFrame:
    return df.where(is_recent(before(as_of_col(df, as_of), window_s))).agg(F.count("*").alias("n"))


@operator
def recent_threats(threats: DataFrame, limit: int = 10, geo: DataFrame | None = None, ranges: DataFrame | None = None) -> DataFrame:
    """Latest threats with level and place; only the listed ones are looked up."""
    latest = threats.orderBy(F.desc("timestamp"), F.desc("id")).limit(limit)
    leveled = latest.withColumn("risk_level", scoring.band(F.col("risk_score"), "listing"))
    return geo_enrich(leveled, geo, ranges)


@operator
def threats_by_ip(threats: DataFrame, ip: str, limit: int = 10) -> DataFrame:
    return threats.where(F.col("source_ip") == ip).orderBy(F.desc("risk_score"), F.asc("id")).limit(limit)


@operator
def threat_status_apply(threats: DataFrame, changes: DataFrame) -> DataFrame:
    """Status of each threat after its latest change; ``changes`` has (change_id, target_id, status,
    changed_at)."""
    latest = changes.groupBy(F.col("target_id").alias("id")).agg(
        F.max_by("status", F.struct("changed_at", "change_id")).alias("_new")
    )
    return threats.join(latest, "id", "left").select(
        *[F.coalesce("_new", "status").alias("status") if c == "status" else F.col(c) for c in threats.columns]
    )


@operator
def threat_status_audit(threats: DataFrame, changes: DataFrame) -> DataFrame:
    """One audit row per change of a known threat, with the status before and after."""
    from pyspark.sql import Window

    w = Window.partitionBy("target_id").orderBy("changed_at", "change_id")
    steps = changes.withColumn("_before", F.lag("status").over(w))
    known = threats.select(F.col("id").alias("target_id"), F.col("status").alias("_first"), "threat_type", "source_ip")
    return steps.join(known, "target_id").select(
        F.col("changed_at").alias("timestamp"),
        F.col("user"),
        F.lit("threat_status_update").alias("action"),
        F.lit("threat").alias("resource_type"),
        F.col("target_id").cast("string").alias("resource_id"),
        F.concat(
            F.lit("Status changed from "), F.coalesce("_before", "_first"), F.lit(" to "), "status",
            F.lit(" for "), "threat_type", F.lit(" ("), "source_ip", F.lit(")"),
        ).alias("details"),
        F.lit("info").alias("severity"),
        "change_id",
    )


INCIDENT_FIELDS = ["status", "severity", "priority", "assigned_to", "resolution_notes"]


@operator
def incident_apply_changes(incidents: DataFrame, changes: DataFrame) -> DataFrame:
    """Incidents after all changes: per field the latest given value; resolving sets resolved_at.

    ``changes`` has (change_id, target_id, changed_at) and any of the changeable fields; null means
    not given.
    """
    fields = [f for f in INCIDENT_FIELDS if f in changes.columns]
    when = F.struct("changed_at", "change_id")
    latest = changes.groupBy(F.col("target_id").alias("id")).agg(
        *[F.max_by(f, F.when(F.col(f).isNotNull(), when)).alias(f"_{f}") for f in fields],
        F.max(F.when(F.col("status") == "resolved", F.col("changed_at"))).alias("_resolved_at"),
        F.max("changed_at").alias("_updated_at"),
    )
    joined = incidents.join(latest, "id", "left")
    updated = {f: F.coalesce(f"_{f}", f) if f in incidents.columns else F.col(f"_{f}") for f in fields}
    for name in ("resolved_at", "updated_at"):
        updated[name] = F.coalesce(f"_{name}", name) if name in incidents.columns else F.col(f"_{name}")
    columns = list(dict.fromkeys([*incidents.columns, *updated]))
    return joined.select(*[updated[c].alias(c) if c in updated else F.col(c) for c in columns])


@operator
def incident_escalate(incidents: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One severity step up and one priority step down for the asked incidents; those at the top
    stay and are marked as not escalated."""
    up = F.create_map(*[F.lit(x) for x in ("low", "medium", "medium", "high", "high", "critical")])
    if ids is None:
        asked, rows = F.lit(True), incidents
    else:
        rows = incidents.join(ids.select("id").distinct().withColumn("_asked", F.lit(True)), "id", "left")
        asked = F.coalesce("_asked", F.lit(False))
    step = asked & F.element_at(up, F.col("severity")).isNotNull()
    return rows.withColumn("_step", step).select(
        *[
            F.when(F.col("_step"), F.element_at(up, F.col("severity"))).otherwise(F.col("severity")).alias("severity")
            if c == "severity"
            else F.when(F.col("_step"), F.greatest(F.lit(1), F.col("priority") - 1)).otherwise(F.col("priority")).alias("priority")
            if c == "priority"
            else F.col(c)
            for c in incidents.columns
        ],
        F.col("_step").alias("escalated"),
    )


@operator
def audit_recent(audit: DataFrame, limit: int = 100, tie: str = "id") -> DataFrame:
    return audit.orderBy(F.desc("timestamp"), F.desc(tie)).limit(limit)


@operator
def search_history_recent(history: DataFrame, limit: int = 20, keep: int = 100, tie: str = "indicator") -> DataFrame:
    """The latest ``limit`` of the ``keep`` searches that are kept."""
    return history.orderBy(F.desc("timestamp"), F.asc(tie)).limit(min(limit, keep))


@operator
def honeypot_threats(logs: DataFrame, paths=tuple(rules.HONEYPOT_PATHS)) -> DataFrame:
    """A threat for every access to a trap path."""
    path = parsing.url_path(F.col("parsed_data.url"))
    return logs.where(path.isin(*paths)).select(
        "id",
        F.lit("honeypot").alias("threat_type"),
        "source_ip",
        F.lit(rules.HONEYPOT_SCORE).alias("risk_score"),
        F.concat_ws(" ", F.lit("Honeypot triggered:"), F.col("parsed_data.method"), path).alias("description"),
        "timestamp",
        "ingested_at",
        F.lit("active").alias("status"),
    )


@operator
def honeypot_hits(logs: DataFrame, paths=tuple(rules.HONEYPOT_PATHS), limit: int = 50) -> DataFrame:
    """The latest hits, each with the number of all hits."""
    hits = honeypot_threats(logs, paths)
    total = hits.agg(F.count("*")).scalar()
    return hits.orderBy(F.desc("timestamp"), F.desc("id")).limit(limit).withColumn("total", total)


@operator
def table_listing(
    df: DataFrame, order_by: str = "created_at", active_only: bool = False, where: str | None = None,
    limit: int | None = None, tie: str = "id",
) -> DataFrame:
    """Newest first, optionally only active rows or those that meet a condition."""
    if active_only:
        df = df.where("is_active")
    if where:
        df = df.where(where)
    rows = df.orderBy(F.desc(order_by), F.desc(tie))
    return rows if limit is None else rows.limit(limit)

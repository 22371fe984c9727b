"""Search, de-duplication and status changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.shape import flat
from checks.sqlviews import V_CHANGES, V_EVENT, V_GEO, V_IOC, day, log, threat, with_views
from logwarden.operators import correlate
from logwarden.operators import search as op
from logwarden.plans import views as v


def doubled(s, d):
    """The log view with a copy of every fourth row under a higher id, later for every eighth."""
    logs = v.v_log(s, d)
    late = F.when(F.col("id") % 8 == 0, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 0 HOUR"))
    copies = logs.where("id % 4 = 0").withColumn("timestamp", F.col("timestamp") + late).withColumn("id", F.col("id") + 10_000_000)
    return logs.unionByName(copies)


def incidents(s, d):
    rows = correlate.incident_create(v.v_threat(s, d), assigned_to="team")
    severity = F.element_at(F.array(*map(F.lit, ["low", "medium", "high", "critical"])), (F.col("threat_ids")[0] % 4 + 1).cast("int"))
    return rows.withColumn("id", F.col("threat_ids")[0]).withColumn("severity", severity).drop("updated_at")


def audit(s, d):
    return op.threat_status_audit(v.v_threat(s, d), v.v_changes(s, d))


QUERIES = {
    "log_search": lambda s, d: flat(
        op.log_search(v.v_log(s, d), text="FAILED", source_ip="168.0.1", start="2024-01-03", end="2024-01-25", action="Failed", limit=30, offset=5),
        "id", "timestamp AS ts", "source_ip", "action", "raw_log AS raw", "total"),
    "log_dedup_exact": lambda s, d: flat(op.log_dedup_exact(doubled(s, d), v.v_log(s, d).where("id % 5 = 0")), "id"),
    "log_dedup_content": lambda s, d: flat(op.log_dedup_content(doubled(s, d), v.v_log(s, d).where("id % 5 = 0")), "id"),
    "recent_window_count": lambda s, d: flat(op.recent_window_count(v.v_log(s, d), as_of="2024-01-20 12:00:00")),
    "recent_threats": lambda s, d: flat(
        op.recent_threats(v.v_threat(s, d), 25, v.v_geo(s, d), v.v_geo_ranges(s, d)), "id", "risk_level", "country", "timestamp AS ts"),
    "threats_by_ip": lambda s, d: flat(op.threats_by_ip(v.v_threat(s, d), "10.0.0.5"), "id", "risk_score"),
    "threat_status_apply": lambda s, d: flat(op.threat_status_apply(v.v_threat(s, d), v.v_changes(s, d)), "id", "status"),
    "threat_status_audit": lambda s, d: flat(audit(s, d), "change_id", "resource_id", "details", "timestamp AS ts", "`user` AS who"),
    "incident_apply_changes": lambda s, d: flat(
        op.incident_apply_changes(
            incidents(s, d),
            v.v_changes(s, d).select(
                "change_id", "target_id", "changed_at", "status",
                F.when(F.col("change_id") % 2 == 0, F.col("user")).alias("assigned_to"),
                F.when(F.col("change_id") % 5 == 0, F.lit(1)).alias("priority"))),
        "id", "status", "assigned_to", "priority", "resolved_at", "updated_at"),
    "incident_escalate": lambda s, d: flat(
        op.incident_escalate(incidents(s, d), incidents(s, d).where("id % 3 = 0").select("id")), "id", "severity", "priority", "escalated"),
    "audit_recent": lambda s, d: flat(op.audit_recent(audit(s, d), tie="change_id"), "change_id", "timestamp AS ts"),
    "search_history_recent": lambda s, d: flat(
        op.search_history_recent(v.v_log(s, d).select(F.col("source_ip").alias("indicator"), "timestamp", "id"), limit=20, tie="id"),
        "indicator", "timestamp AS ts"),
    "honeypot_hits": lambda s, d: flat(
        op.honeypot_hits(v.v_log(s, d)), "id", "source_ip", "risk_score", "description", "timestamp AS ts", "total"),
    "honeypot_threats": lambda s, d: flat(op.honeypot_threats(v.v_log(s, d)), "id", "threat_type", "description"),
    "table_listing": lambda s, d: flat(
        op.table_listing(v.v_ioc(s, d), active_only=True, where="ioc_type = 'ip'", limit=3), "id", "value", "created_at AS ts"),
}

SEVERITY = "CASE id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'critical' END"
INC = f"inc AS (SELECT id, {SEVERITY} AS severity, CASE WHEN risk_score >= 7 THEN 1 ELSE 2 END AS priority FROM v_threat WHERE risk_score >= 5)"
AUDIT = """audit AS (
  SELECT change_id, CAST(target_id AS VARCHAR) AS resource_id, changed_at, "user" AS who,
    'Status changed from ' || coalesce(lag(c.status) OVER (PARTITION BY target_id ORDER BY changed_at, change_id), t.status) || ' to ' || c.status
      || ' for ' || threat_type || ' (' || source_ip || ')' AS details
  FROM v_changes c JOIN v_threat t ON t.id = target_id)"""

ORACLE = {
    "log_search": log(f"""
        , m AS (SELECT *, count(*) OVER () AS total FROM v_log WHERE raw ILIKE '%failed%' AND source_ip ILIKE '%168.0.1%'
          AND ts >= TIMESTAMP '2024-01-03' AND ts <= TIMESTAMP '2024-01-25' AND action = 'Failed')
        SELECT id, {day('ts')} AS ts, source_ip, action, raw, total FROM m ORDER BY m.ts DESC, id DESC LIMIT 30 OFFSET 5"""),
    "log_dedup_exact": log("""
        SELECT id FROM v_log WHERE id % 5 <> 0 UNION ALL SELECT id + 10000000 FROM v_log WHERE id % 8 = 0"""),
    "log_dedup_content": log("SELECT id FROM v_log WHERE id % 5 <> 0"),
    "recent_window_count": log("""
        SELECT count(*) AS n FROM v_log WHERE ts >= TIMESTAMP '2024-01-19 12:00:00' OR ingested_at >= TIMESTAMP '2024-01-19 12:00:00'"""),
    "recent_threats": threat(f"""
        , t AS (SELECT * FROM v_threat ORDER BY ts DESC, id DESC LIMIT 25)
        SELECT id, CASE WHEN risk_score >= 7 THEN 'HIGH' WHEN risk_score >= 4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level, country, {day('ts')} AS ts
        FROM t JOIN v_geo ON ip = source_ip""", V_GEO),
    "threats_by_ip": threat("SELECT id, risk_score FROM v_threat WHERE source_ip = '10.0.0.5' ORDER BY risk_score DESC, id LIMIT 10"),
    "threat_status_apply": threat("""
        , l AS (SELECT target_id, max_by(status, (changed_at, change_id)) AS status FROM v_changes GROUP BY target_id)
        SELECT id, coalesce(l.status, t.status) AS status FROM v_threat t LEFT JOIN l ON target_id = id""", V_CHANGES),
    "threat_status_audit": threat(f", {AUDIT} SELECT change_id, resource_id, details, {day('changed_at')} AS ts, who FROM audit", V_CHANGES),
    "incident_apply_changes": threat(f""", {INC}
        SELECT id, coalesce(max_by(c.status, (changed_at, change_id)), 'open') AS status,
          coalesce(max_by("user", (changed_at, change_id)) FILTER (change_id % 2 = 0), 'team') AS assigned_to,
          CAST(CASE WHEN count(*) FILTER (change_id % 5 = 0) > 0 THEN 1 ELSE max(priority) END AS BIGINT) AS priority,
          coalesce({day("max(changed_at) FILTER (c.status = 'resolved')")}, '') AS resolved_at, coalesce({day('max(changed_at)')}, '') AS updated_at
        FROM inc LEFT JOIN v_changes c ON target_id = id GROUP BY id""", V_CHANGES),
    "incident_escalate": threat(f""", {INC}
        SELECT id, CASE WHEN e THEN (CASE severity WHEN 'low' THEN 'medium' WHEN 'medium' THEN 'high' ELSE 'critical' END) ELSE severity END AS severity,
          CAST(CASE WHEN e THEN greatest(1, priority - 1) ELSE priority END AS BIGINT) AS priority, e AS escalated
        FROM (SELECT *, id % 3 = 0 AND severity <> 'critical' AS e FROM inc)"""),
    "audit_recent": threat(f", {AUDIT} SELECT change_id, {day('changed_at')} AS ts FROM audit ORDER BY changed_at DESC, change_id DESC LIMIT 100", V_CHANGES),
    "search_history_recent": log(f"SELECT source_ip AS indicator, {day('v_log.ts')} AS ts FROM v_log ORDER BY v_log.ts DESC, id LIMIT 20"),
    "honeypot_hits": log(f"""
        , h AS (SELECT *, count(*) OVER () AS total FROM v_log WHERE event_type = 'click' AND k % 6 = 4)
        SELECT id, source_ip, 8.5e0 AS risk_score, 'Honeypot triggered: GET /wp-admin' AS description, {day('h.ts')} AS ts, total
        FROM h ORDER BY h.ts DESC, id DESC LIMIT 50"""),
    "honeypot_threats": log("""
        SELECT id, 'honeypot' AS threat_type, 'Honeypot triggered: GET /wp-admin' AS description FROM v_log WHERE event_type = 'click' AND k % 6 = 4"""),
    "table_listing": with_views(
        f"SELECT id, value, {day('created_at')} AS ts FROM v_ioc WHERE is_active ORDER BY created_at DESC, id DESC LIMIT 3", V_EVENT, V_IOC),
}

"""Reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.q_search import incidents
from checks.shape import flat
from checks.sqlviews import V_LOG, V_THREAT, day, log, round_1, threat, with_views
from logwarden import rules
from logwarden.operators import reports as op
from logwarden.operators import risk
from logwarden.operators import text
from logwarden.operators.alerts import alert_candidates
from logwarden.plans import views as v


def alerts(s, d):
    return alert_candidates(v.v_threat(s, d)).select(F.col("id").alias("threat_id"), F.when(F.col("id") % 2 == 0, "yes").otherwise("no").alias("sent"))


QUERIES = {
    "system_stats": lambda s, d: flat(op.system_stats(v.v_threat(s, d), v.v_log(s, d), alerts(s, d))),
    "dashboard_snapshot": lambda s, d: flat(
        op.dashboard_snapshot(v.v_threat(s, d), v.v_log(s, d)), "section", "key", "n", "text", "timestamp AS ts"),
    "top_threat_types": lambda s, d: flat(op.top_threat_types(v.v_threat(s, d), 3)),
    "top_source_ips": lambda s, d: flat(op.top_source_ips(v.v_threat(s, d))),
    "highest_and_latest_threat": lambda s, d: flat(
        op.highest_and_latest_threat(v.v_threat(s, d)), "section", "id", "threat_type", "source_ip", "risk_score", "status"),
    "risk_threshold_counts": lambda s, d: flat(op.risk_threshold_counts(v.v_threat(s, d))),
    "executive_summary": lambda s, d: flat(op.executive_summary(v.v_threat(s, d), v.v_log(s, d))),
    "executive_list": lambda s, d: flat(op.executive_list(v.v_threat(s, d)), "id", "threat_type", "risk_level", "status", "timestamp AS ts"),
    "risk_level_distribution": lambda s, d: flat(op.risk_level_distribution(v.v_threat(s, d))),
    "attack_timeline": lambda s, d: flat(
        op.attack_timeline(v.v_threat(s, d), incidents(s, d), hours=72), "timestamp AS ts", "type", "title", "description", "severity", "id"),
    "attack_heatmap": lambda s, d: flat(op.attack_heatmap(v.v_threat(s, d))),
    "mitre_heatmap": lambda s, d: flat(op.mitre_heatmap(v.v_threat(s, d))),
    "retention_report": lambda s, d: flat(op.retention_report(v.v_log(s, d), days=20)),
    "logs_per_second": lambda s, d: flat(op.logs_per_second(v.v_log(s, d), as_of="2024-01-15 12:00:00")),
    "logs_per_second_by_minute": lambda s, d: flat(op.logs_per_second_by_minute(v.v_log(s, d))),
    "alert_message_text": lambda s, d: flat(
        text.alert_message_text(
            risk.risk_recommendations(v.v_threat(s, d).withColumn("risk_level", op.scoring.band(F.col("risk_score"))))), "id", "message"),
    "explanation_text": lambda s, d: flat(
        text.explanation_text(v.v_threat(s, d).withColumn("risk_level", op.scoring.band(F.col("risk_score")))), "id", "explanation"),
    "message_intent_tag": lambda s, d: flat(text.message_intent_tag(v.table(s, d, "conversations")), "conv_id", "turn", "intent"),
    "message_intent_counts": lambda s, d: flat(text.message_intent_counts(v.table(s, d, "conversations"))),
    "message_intent_tag_documents": lambda s, d: flat(text.message_intent_tag(v.table(s, d, "documents")), "doc_id", "intent"),
}

LAST = "(SELECT max(ts) FROM v_threat)"
LEVEL = "CASE WHEN risk_score >= 8 THEN 'CRITICAL' WHEN risk_score >= 6 THEN 'HIGH' WHEN risk_score >= 4 THEN 'MEDIUM' WHEN risk_score >= 2 THEN 'LOW' ELSE 'INFO' END"
CANDIDATE = "(risk_score >= 6 OR (threat_type IN ('brute_force', 'suspicious_pattern') AND risk_score >= 5))"
TITLE = "CASE threat_type WHEN 'brute_force' THEN 'Brute Force' WHEN 'port_scan' THEN 'Port Scan' WHEN 'suspicious_pattern' THEN 'Suspicious Pattern' WHEN 'anomaly' THEN 'Anomaly' ELSE 'Ddos' END"
V_LOG_ONLY = V_LOG.split("v_event AS", 1)[1].split("v_log_raw AS", 1)[1]
BOTH = (V_THREAT, "v_log_raw AS" + V_LOG_ONLY)


def stats(seconds: int) -> str:
    recent = f"(ts >= {LAST} - INTERVAL {seconds} SECOND OR ingested_at >= {LAST} - INTERVAL {seconds} SECOND)"
    return f"""SELECT 'threats' AS section, 'total_threats' AS key, count(*) AS n FROM v_threat
        UNION ALL SELECT 'threats', 'active_threats', count(*) FROM v_threat WHERE status = 'active'
        UNION ALL SELECT 'threats', 'recent_threats', count(*) FROM v_threat WHERE {recent}
        UNION ALL SELECT 'threats_by_type', threat_type, count(*) FROM v_threat GROUP BY threat_type
        UNION ALL SELECT 'logs', 'total_logs', count(*) FROM v_log
        UNION ALL SELECT 'logs', 'recent_logs', count(*) FROM v_log WHERE {recent}"""


def pick(section: str, where: str, order: str) -> str:
    return f"(SELECT '{section}' AS section, id, threat_type, source_ip, risk_score, status FROM v_threat WHERE {where} ORDER BY {order} LIMIT 1)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def cases(column: str, values: dict, default: str) -> str:
    return f"(CASE {column} " + " ".join(f"WHEN {quoted(k)} THEN {x}" for k, x in values.items()) + f" ELSE {default} END)"


def numbered(lines) -> str:
    return "".join(f"{i}. {line}\n" for i, line in enumerate(lines[:3], 1))


def score_text(column: str) -> str:
    return f"printf('%s', {column})"


RECS = cases("threat_type", {k: quoted("\nRecommendations:\n" + numbered(x)) for k, x in rules.RECOMMENDATIONS.items()},
             f"(CASE WHEN risk_score >= 8 THEN {quoted(chr(10) + 'Recommendations:' + chr(10) + numbered(rules.CRITICAL_RECOMMENDATIONS))} ELSE '' END)")
ICON = cases("level", {k: quoted(x) for k, x in rules.LEVEL_ICONS.items()}, quoted("⚠️"))


def explained(template: str) -> str:
    text = quoted(template)
    for name, column in (("level", "level"), ("ip", "source_ip"), ("score", "CAST(risk_score AS VARCHAR)"), ("type", "threat_type")):
        text = f"replace({text}, '{{{name}}}', {column})"
    return text


def intent_sql(table: str, keys: str) -> str:
    whens = " ".join(
        f"WHEN regexp_matches(lower(trim(text)), {quoted(text.intent_pattern(words))}) THEN '{name}'" for name, words in rules.INTENTS)
    return f"SELECT {keys}, CASE {whens} ELSE 'other' END AS intent FROM {table}"


MITRE = "tech AS (SELECT * FROM (VALUES " + ", ".join(
    "(" + ", ".join(quoted(x) for x in row) + ")" for row in rules.MITRE_TECHNIQUES) + ") AS t(threat_type, technique_id, technique, tactic))"

ORACLE = {
    "system_stats": with_views(f"{stats(86400)} UNION ALL SELECT 'alerts', 'alerts_sent', count(*) FROM v_threat WHERE {CANDIDATE} AND id % 2 = 0", *BOTH),
    "dashboard_snapshot": with_views(f"""
        SELECT section, key, n, '' AS text, '' AS ts FROM ({stats(3600)})
        UNION ALL (SELECT 'latest_threats', source_ip, id, description, {day('v_threat.ts')} FROM v_threat ORDER BY v_threat.ts DESC, id DESC LIMIT 20)
        UNION ALL (SELECT 'latest_logs', source_ip, id, substr(raw, 1, 200), {day('v_log.ts')} FROM v_log ORDER BY v_log.ts DESC, id DESC LIMIT 10)""", *BOTH),
    "top_threat_types": threat("SELECT threat_type, count(*) AS n FROM v_threat GROUP BY threat_type ORDER BY n DESC, threat_type LIMIT 3"),
    "top_source_ips": threat("""
        SELECT source_ip, count(*) AS n, max(risk_score) AS max_score FROM v_threat GROUP BY source_ip ORDER BY n DESC, source_ip LIMIT 5"""),
    "highest_and_latest_threat": threat(" UNION ALL ".join([
        pick("highest", "true", "risk_score DESC, id"), pick("latest", "true", "ts DESC, id DESC"),
        pick("highest_active", "status = 'active'", "risk_score DESC, id"), pick("latest_active", "status = 'active'", "ts DESC, id DESC")])),
    "risk_threshold_counts": threat("""
        SELECT count(*) FILTER (risk_score >= 7) AS high, count(*) FILTER (risk_score >= 9) AS critical FROM v_threat"""),
    "executive_summary": with_views(f"""
        SELECT 'total' AS section, 'logs' AS key, count(*) AS n, -1e0 AS share FROM v_log
        UNION ALL SELECT 'total', 'threats', count(*), -1e0 FROM v_threat
        UNION ALL SELECT 'total', 'active', count(*), -1e0 FROM v_threat WHERE status = 'active'
        UNION ALL SELECT 'total', 'resolved', count(*), -1e0 FROM v_threat WHERE status = 'resolved'
        UNION ALL SELECT 'level', {LEVEL}, count(*), -1e0 FROM v_threat GROUP BY 2
        UNION ALL SELECT 'type', threat_type, count(*), round(count(*) * 1e0 / (SELECT count(*) FROM v_threat) * 100, 1) FROM v_threat GROUP BY 2""", *BOTH),
    "executive_list": threat(f"SELECT id, threat_type, {LEVEL} AS risk_level, status, {day('ts')} AS ts FROM v_threat"),
    "risk_level_distribution": threat(f"SELECT {LEVEL} AS risk_level, count(*) AS n FROM v_threat GROUP BY 1"),
    "attack_timeline": threat(f"""
        , cut AS (SELECT max(ts) - INTERVAL 72 HOUR AS c FROM v_threat)
        SELECT {day('CASE WHEN v_threat.ts >= c THEN v_threat.ts ELSE ingested_at END')} AS ts, 'threat' AS type, 'Threat: ' || threat_type AS title, description,
          CASE WHEN risk_score >= 7 THEN 'critical' WHEN risk_score >= 4 THEN 'high' WHEN risk_score >= 2 THEN 'medium' ELSE 'low' END AS severity,
          CAST(id AS VARCHAR) AS id FROM v_threat, cut WHERE v_threat.ts >= c OR ingested_at >= c
        UNION ALL SELECT {day('v_threat.ts')}, 'incident', 'Incident: ' || {TITLE} || ' from ' || source_ip, description,
          CASE id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'critical' END,
          'INC-' || strftime(v_threat.ts, '%Y%m%d') || '-' || upper(substr(md5(CAST(id AS VARCHAR)), 1, 8))
        FROM v_threat, cut WHERE risk_score >= 5 AND v_threat.ts >= c"""),
    "attack_heatmap": threat("""
        , slots AS (SELECT 'hour' AS section, h AS slot, CAST(h AS VARCHAR) AS label, (SELECT count(*) FROM v_threat WHERE hour(ts) = h) AS n FROM range(24) r(h)
          UNION ALL SELECT 'day', w, ['Sun','Mon','Tue','Wed','Thu','Fri','Sat'][w + 1], (SELECT count(*) FROM v_threat WHERE dayofweek(ts) = w) FROM range(7) r(w))
        SELECT *, row_number() OVER (PARTITION BY section ORDER BY n DESC, slot) = 1 AS is_peak FROM slots"""),
    "mitre_heatmap": threat(f"""
        , {MITRE}, t AS (SELECT threat_type, count(*) AS c, max(risk_score) AS top FROM v_threat GROUP BY threat_type)
        SELECT threat_type, technique_id, technique, tactic, c AS count, {round_1('top')} AS max_score,
          CASE WHEN top >= 9 THEN 'critical' WHEN top >= 7 THEN 'high' WHEN top >= 4 THEN 'medium' ELSE 'low' END AS severity FROM t JOIN tech USING (threat_type)
        UNION ALL SELECT threat_type, technique_id, technique, tactic, 0, 0e0, 'none' FROM tech
        WHERE technique_id NOT IN (SELECT technique_id FROM t JOIN tech USING (threat_type))"""),
    "retention_report": log("""
        SELECT count(*) AS total_logs, count(*) FILTER (ts < (SELECT max(ts) FROM v_log) - INTERVAL 20 DAY) AS old_logs,
          count(DISTINCT source_ip) AS unique_ips, count(*) FILTER (ts < (SELECT max(ts) FROM v_log) - INTERVAL 20 DAY) = 0 AS compliant FROM v_log"""),
    "logs_per_second": log("SELECT round(count(*) / 60e0, 2) AS logs_per_second FROM v_log WHERE ts >= TIMESTAMP '2024-01-15 11:59:00'"),
    "logs_per_second_by_minute": log(f"""
        SELECT {day("date_trunc('minute', ts)")} AS minute, count(*) AS n, round(count(*) / 60e0, 2) AS logs_per_second FROM v_log GROUP BY 1"""),
    "alert_message_text": threat(f"""
        , t AS (SELECT *, {LEVEL} AS level FROM v_threat)
        SELECT id, {ICON} || ' SECURITY ALERT ' || {ICON} || chr(10) || chr(10) || 'Threat Type: ' || {TITLE} || chr(10) || 'Source IP: ' || source_ip
          || chr(10) || 'Risk Score: ' || CAST(risk_score AS VARCHAR) || '/10.0 (' || level || ')' || chr(10) || 'Time: ' || {day('ts')} || ' UTC'
          || chr(10) || chr(10) || 'Description:' || chr(10) || description || chr(10) || chr(10) || {RECS} || chr(10) || 'Threat ID: ' || id AS message FROM t"""),
    "explanation_text": threat(f"""
        , t AS (SELECT *, {LEVEL} AS level FROM v_threat)
        SELECT id, {cases('threat_type', {k: explained(x) for k, x in rules.EXPLANATION_TEXTS.items()}, explained(rules.EXPLANATION_DEFAULT))} AS explanation FROM t"""),
    "message_intent_tag": intent_sql("conversations", "conv_id, turn"),
    "message_intent_counts": f"SELECT intent, count(*) AS n FROM ({intent_sql('conversations', 'conv_id')}) GROUP BY intent",
    "message_intent_tag_documents": intent_sql("documents", "doc_id"),
}

"""The whole batch job, from entries to patterns."""

from __future__ import annotations

from checks.q_detect import BRUTE_3D, DAY, HITS, PATTERN_1D, SCAN_10D
from checks.q_streaming import MULT, TIME
from checks.shape import flat, scratch
from checks.sqlviews import day, log, round_1
from logwarden.plans import soc
from logwarden.plans import views as v

SETTINGS = {
    "brute_force": {"window_s": 3 * DAY}, "port_scan": {"window_s": 10 * DAY, "min_attempts": 5, "min_ports": 4},
    "suspicious_pattern": {"window_s": DAY},
}
EVERY = {name: 1 for name in ("brute_force", "port_scan", "suspicious_activity")}


def batch(s, d, table):
    """One table of the job over all entries, of which a quarter comes twice; the isolation forest has no SQL."""
    logs = v.v_log(s, d)
    twice = logs.unionByName(logs.where("id % 4 = 0"))
    return soc.soc_batch(twice, scratch(s, "soc"), thresholds=EVERY, hours=None, anomalies=False, **SETTINGS)[table]


QUERIES = {
    "soc_batch_threats": lambda s, d: flat(batch(s, d, "threat"), "threat_type", "source_ip", "risk_score", "risk_level", "timestamp AS ts"),
    "soc_batch_alerts": lambda s, d: flat(
        batch(s, d, "alert"), "length(threat_id) = 32 AS has_id", "count(*) OVER (PARTITION BY threat_id) AS same_id", "created_at AS ts"),
    "soc_batch_incidents": lambda s, d: flat(batch(s, d, "incident"), "severity", "priority", "ioc_ids", "created_at AS ts"),
    "soc_batch_patterns": lambda s, d: flat(batch(s, d, "attack_pattern"), "pattern_type", "pattern_key", "event_count"),
}

SCORED = f""", {HITS},
    found AS ({BRUTE_3D} UNION ALL {SCAN_10D} UNION ALL {PATTERN_1D}),
    s AS (SELECT *, least((risk_score * 0.6e0 + {TIME} * 0.1e0) * {MULT}, 10e0) AS u FROM found),
    r AS (SELECT threat_type, source_ip, ts, {round_1('u')} AS risk_score,
      CASE WHEN u >= 8 THEN 'CRITICAL' WHEN u >= 6 THEN 'HIGH' WHEN u >= 4 THEN 'MEDIUM' WHEN u >= 2 THEN 'LOW' ELSE 'INFO' END AS risk_level FROM s)"""

ORACLE = {
    "soc_batch_threats": log(f"{SCORED} SELECT threat_type, source_ip, risk_score, risk_level, {day('ts')} AS ts FROM r"),
    "soc_batch_alerts": log(f"""{SCORED} SELECT true AS has_id, 1 AS same_id, {day('ts')} AS ts FROM r
        WHERE risk_level IN ('CRITICAL', 'HIGH') OR risk_score >= 7 OR (threat_type IN ('brute_force', 'suspicious_pattern') AND risk_score >= 5)"""),
    "soc_batch_incidents": log(f"""{SCORED} SELECT CASE WHEN risk_score >= 7 THEN 'high' ELSE 'medium' END AS severity,
        CASE WHEN risk_score >= 7 THEN 1 ELSE 2 END AS priority, source_ip AS ioc_ids, {day('ts')} AS ts FROM r WHERE risk_score >= 5"""),
    "soc_batch_patterns": log(f"""{SCORED} SELECT CASE threat_type WHEN 'suspicious_pattern' THEN 'suspicious_activity' ELSE threat_type END AS pattern_type,
        source_ip AS pattern_key, count(*) AS event_count FROM r GROUP BY ALL"""),
}

"""Detectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.shape import flat
from checks.sqlviews import V_THREAT, day, log, threat
from logwarden.operators import detect as op
from logwarden.plans import views as v

DAY = 86400


def three_detectors(s, d):
    logs = v.v_log(s, d)
    return op.threat_union(
        op.detect_brute_force(logs, window_s=3 * DAY),
        op.detect_port_scan(logs, window_s=10 * DAY, min_attempts=5, min_ports=4),
        op.detect_suspicious_pattern(logs, window_s=DAY),
    )


def four_detectors(s, d):
    """The isolation forest has no SQL, so ``threat_union`` and its SQL keep the other three."""
    return op.threat_union(three_detectors(s, d), op.detect_anomalies(v.v_log(s, d)))


QUERIES = {
    "detect_brute_force": lambda s, d: flat(
        op.detect_brute_force(v.v_log(s, d), window_s=DAY),
        "threat_type", "source_ip", "risk_score", "description", "timestamp AS ts", "details.attempt_count",
        "details.time_window", "transform(details.attempts, a -> concat(date_format(a.at, 'yyyy-MM-dd HH:mm:ss'), 'x', a.n)) AS attempts",
    ),
    "detect_brute_force_sliding": lambda s, d: flat(
        op.detect_brute_force_sliding(v.v_log(s, d), window_s=DAY, threshold=3),
        "source_ip", "risk_score", "details.attempt_count", "timestamp AS ts", "description",
    ),
    "detect_port_scan": lambda s, d: flat(
        op.detect_port_scan(v.v_log(s, d), window_s=10 * DAY, min_attempts=5, min_ports=4),
        "source_ip", "risk_score", "details.total_attempts", "details.unique_ports", "details.ports_scanned", "timestamp AS ts",
        "description",
    ),
    "detect_port_scan_sliding": lambda s, d: flat(
        op.detect_port_scan_sliding(v.v_log(s, d), window_s=10 * DAY, min_attempts=5, min_ports=4),
        "source_ip", "risk_score", "details.total_attempts", "details.unique_ports", "timestamp AS ts",
    ),
    "detect_suspicious_pattern": lambda s, d: flat(
        op.detect_suspicious_pattern(v.v_log(s, d), window_s=DAY),
        "source_ip", "risk_score", "details.total_matches", "timestamp AS ts", "description",
        "array_sort(transform(map_entries(details.pattern_breakdown), e -> concat(e.key, '=', e.value))) AS breakdown",
        "details.recent_matches",
    ),
    "threat_union": lambda s, d: flat(three_detectors(s, d), "threat_type", "source_ip", "risk_score", "timestamp AS ts"),
    "threat_union_all": lambda s, d: flat(four_detectors(s, d), "threat_type", "source_ip", "risk_score", "timestamp AS ts"),
    "threat_dedup_15m": lambda s, d: flat(
        op.threat_dedup_15m(
            v.v_threat(s, d).where("id % 3 <> 0"), v.v_threat(s, d).where("id % 3 = 0"), gap_s=DAY),
        "id", "source_ip", "threat_type",
    ),
    "threat_dedup_chain": lambda s, d: flat(op.threat_dedup_chain(v.v_threat(s, d), gap_s=2 * DAY), "id", "source_ip", "threat_type"),
    "threat_log_link": lambda s, d: flat(
        op.threat_log_link(v.v_threat(s, d), v.v_log(s, d)), "threat_id", "source_ip", "threat_type", "log_id"),
    "detector_retention": lambda s, d: flat(op.detector_retention(v.v_log(s, d)), "id", "timestamp AS ts"),
}

FAILED = """(event_type IN ('error', 'click') OR (event_type = 'purchase' AND k % 5 <> 0) OR (event_type = 'view' AND k % 10 = 0))"""
SCAN = "(event_type = 'purchase' AND k % 5 <> 0)"
LAST = "(SELECT max(ts) FROM v_log)"
WEIGHT = """(CASE tag WHEN 'sql_injection' THEN 3e0 WHEN 'xss' THEN 2.5e0 WHEN 'command_injection' THEN 3e0
  WHEN 'path_traversal' THEN 2e0 WHEN 'brute_force_indicators' THEN 1.5e0 ELSE 1e0 END)"""
BRUTE_3D = f"""SELECT 'brute_force' AS threat_type, source_ip, least(count(*) * 2e0, 10e0) AS risk_score, max(ts) AS ts
  FROM v_log WHERE {FAILED} AND ts >= {LAST} - INTERVAL 3 DAY GROUP BY source_ip HAVING count(*) >= 5"""
SCAN_10D = f"""SELECT 'port_scan' AS threat_type, source_ip, least(round(count(*) * 0.3e0 + count(DISTINCT port) * 0.5e0, 1), 10e0) AS risk_score,
  max(ts) AS ts FROM v_log WHERE {SCAN} AND ts >= {LAST} - INTERVAL 10 DAY GROUP BY source_ip
  HAVING count(*) >= 5 AND count(DISTINCT port) >= 4"""
HITS = f"hits AS (SELECT source_ip, ts, unnest(tags) AS tag FROM v_log WHERE ts >= {LAST} - INTERVAL 1 DAY)"
PATTERN_1D = f"""SELECT 'suspicious_pattern' AS threat_type, source_ip, least(round(sum({WEIGHT}), 1), 10e0) AS risk_score, max(ts) AS ts
  FROM hits GROUP BY source_ip HAVING count(*) >= 3"""

ORACLE = {
    "detect_brute_force": log(f"""
        , per AS (SELECT source_ip, ts, count(*) AS n FROM v_log WHERE {FAILED} AND ts >= {LAST} - INTERVAL 1 DAY GROUP BY ALL)
        SELECT 'brute_force' AS threat_type, source_ip, least(sum(n) * 2e0, 10e0) AS risk_score,
          'Brute force attack detected: ' || sum(n) || ' failed attempts in 86400 seconds' AS description, {day('max(ts)')} AS ts,
          CAST(sum(n) AS BIGINT) AS attempt_count, CAST(86400 AS BIGINT) AS time_window,
          string_agg({day('ts')} || 'x' || n, '|' ORDER BY ts) AS attempts
        FROM per GROUP BY source_ip HAVING sum(n) >= 5"""),
    "detect_brute_force_sliding": log(f"""
        , f AS (SELECT source_ip, ts FROM v_log WHERE {FAILED}),
        w AS (SELECT source_ip, ts, count(*) OVER (PARTITION BY source_ip ORDER BY ts RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS n FROM f),
        p AS (SELECT source_ip, max(n) AS n FROM w GROUP BY source_ip)
        SELECT p.source_ip, least(p.n * 2e0, 10e0) AS risk_score, p.n AS attempt_count, {day('min(w.ts)')} AS ts,
          'Brute force attack detected: ' || p.n || ' failed attempts in 86400 seconds' AS description
        FROM p JOIN w ON w.source_ip = p.source_ip AND w.n = p.n WHERE p.n >= 3 GROUP BY p.source_ip, p.n"""),
    "detect_port_scan": log(f"""
        SELECT source_ip, least(round(count(*) * 0.3e0 + count(DISTINCT port) * 0.5e0, 1), 10e0) AS risk_score, count(*) AS total_attempts,
          count(DISTINCT port) AS unique_ports, array_to_string(list_sort(list(DISTINCT port)), '|') AS ports_scanned, {day('max(ts)')} AS ts,
          'Port scan detected: ' || count(*) || ' connection attempts to ' || count(DISTINCT port) || ' different ports' AS description
        FROM v_log WHERE {SCAN} AND ts >= {LAST} - INTERVAL 10 DAY GROUP BY source_ip
        HAVING count(*) >= 5 AND count(DISTINCT port) >= 4"""),
    "detect_port_scan_sliding": log(f"""
        , f AS (SELECT source_ip, ts, port FROM v_log WHERE {SCAN}),
        w AS (SELECT a.source_ip, a.ts, count(*) AS n, count(DISTINCT b.port) AS u
              FROM (SELECT DISTINCT source_ip, ts FROM f) a JOIN f b ON a.source_ip = b.source_ip
               AND b.ts BETWEEN a.ts - INTERVAL 10 DAY AND a.ts GROUP BY a.source_ip, a.ts),
        r AS (SELECT *, row_number() OVER (PARTITION BY source_ip ORDER BY n * 3 + u * 5 DESC, n DESC, u DESC, ts) AS rn
              FROM w WHERE n >= 5 AND u >= 4)
        SELECT source_ip, least(round(n * 0.3e0 + u * 0.5e0, 1), 10e0) AS risk_score, n AS total_attempts, u AS unique_ports, {day('ts')} AS ts
        FROM r WHERE rn = 1"""),
    "detect_suspicious_pattern": log(f"""
        , {HITS},
        t AS (SELECT source_ip, tag, count(*) AS n FROM hits GROUP BY ALL),
        p AS (SELECT source_ip, CAST(sum(n) AS BIGINT) AS total, least(round(sum(n * {WEIGHT}), 1), 10e0) AS score,
               string_agg('''' || tag || ''': ' || n, ', ' ORDER BY tag) AS listed,
               string_agg(tag || '=' || n, '|' ORDER BY tag) AS breakdown FROM t GROUP BY source_ip HAVING sum(n) >= 3),
        r AS (SELECT source_ip, ts, row_number() OVER (PARTITION BY source_ip ORDER BY ts DESC, tag) AS rn FROM hits)
        SELECT p.source_ip, score AS risk_score, total AS total_matches, {day('max(ts)')} AS ts,
          'Suspicious patterns detected: {{' || listed || '}}' AS description, breakdown,
          string_agg({day('ts')}, '|' ORDER BY ts) AS recent_matches
        FROM p JOIN r ON p.source_ip = r.source_ip AND rn <= 5 GROUP BY ALL"""),
    "threat_union": log(f""", {HITS}
        SELECT threat_type, source_ip, risk_score, {day('ts')} AS ts FROM ({BRUTE_3D} UNION ALL {SCAN_10D} UNION ALL {PATTERN_1D})"""),
    "threat_dedup_15m": threat("""
        SELECT id, source_ip, threat_type FROM v_threat n WHERE id % 3 <> 0 AND NOT EXISTS (
          SELECT 1 FROM v_threat s WHERE s.id % 3 = 0 AND s.source_ip = n.source_ip AND s.threat_type = n.threat_type
            AND s.ts BETWEEN n.ts - INTERVAL 1 DAY AND n.ts)"""),
    "threat_dedup_chain": "WITH RECURSIVE " + V_THREAT + """,
        chain AS (
          SELECT source_ip, threat_type, min(ts) AS ts FROM v_threat GROUP BY source_ip, threat_type
          UNION ALL
          SELECT c.source_ip, c.threat_type, min(t.ts) FROM chain c JOIN v_threat t
            ON t.source_ip = c.source_ip AND t.threat_type = c.threat_type AND t.ts > c.ts + INTERVAL 2 DAY
          GROUP BY c.source_ip, c.threat_type, c.ts)
        SELECT min(id) AS id, source_ip, threat_type FROM chain JOIN v_threat USING (source_ip, threat_type, ts)
        GROUP BY source_ip, threat_type, ts""",
    "threat_log_link": log(f"""
        , kinds AS (
          SELECT id, source_ip, unnest(list_filter([
            CASE WHEN event_type = 'error' THEN 'brute_force' END,
            CASE WHEN {SCAN} THEN 'port_scan' END,
            CASE WHEN len(tags) > 0 THEN 'suspicious_pattern' END, 'anomaly'], lambda x: x IS NOT NULL)) AS threat_type FROM v_log),
        first AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_ip, threat_type ORDER BY id) AS rn FROM kinds) WHERE rn <= 5),
        t AS (SELECT id, source_ip, CASE event_type WHEN 'error' THEN 'brute_force' WHEN 'purchase' THEN 'port_scan'
              WHEN 'click' THEN 'suspicious_pattern' WHEN 'signup' THEN 'anomaly' ELSE 'ddos' END AS threat_type FROM v_log)
        SELECT t.id AS threat_id, t.source_ip, t.threat_type, f.id AS log_id FROM t JOIN first f USING (source_ip, threat_type)"""),
    "detector_retention": log(f"SELECT id, {day('ts')} AS ts FROM v_log WHERE ts >= {LAST} - INTERVAL 1 DAY"),
}

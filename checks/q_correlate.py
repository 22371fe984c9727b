"""Patterns, classes, sequences, incidents and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.shape import flat
from checks.sqlviews import day, threat
from logwarden import rules
from logwarden.operators import alerts as al
from logwarden.operators import correlate as op
from logwarden.plans import views as v

HOURS = 240
PATTERN = ("pattern_type", "source_ips", "target_ports", "start_time", "end_time", "event_count", "confidence_score", "description")
THRESHOLDS = {"brute_force": 3, "ddos": 2, "port_scan": 3}


def words(s, d):
    """Threats with texts from the documents, so that the classes have words to find."""
    texts = v.table(s, d, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("description"), F.col("source").alias("threat_type"))
    events = v.v_threat(s, d).select("id", "description", "threat_type", "source_ip", "timestamp")
    return events, texts


MORE_WORDS = {
    "brute_force": " login attempt", "suspicious_pattern": " sql injection union select", "ddos": " flood traffic",
    "anomaly": " malware virus payload", "port_scan": "",
}


def rich(s, d):
    """The threat view with texts in which the classes find enough words."""
    more = None
    for kind, text in MORE_WORDS.items():
        more = F.when(F.col("threat_type") == kind, text) if more is None else more.when(F.col("threat_type") == kind, text)
    return v.v_threat(s, d).withColumn("description", F.concat("description", more))


def suppressions(s, d):
    """One suppression per listed address, one per type and one per text part, some expired or off."""
    rows = v.v_ioc(s, d).select(
        F.lit("ip").alias("suppression_type"), F.col("value").alias("match_value"), "is_active",
        F.lit("2024-01-05").cast("timestamp").alias("created_at"), F.lit("2024-01-20").cast("timestamp").alias("expires_at"))
    n = v.table(s, d, "nation").select(
        F.when(F.col("n_nationkey") < 10, "pattern").otherwise("type").alias("suppression_type"),
        F.when(F.col("n_nationkey") < 10, F.concat(F.lit("CODE 1"), F.col("n_nationkey").cast("string"))).otherwise("anomaly").alias("match_value"),
        (F.col("n_nationkey") % 2 == 0).alias("is_active"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(days=F.col("n_nationkey"))).alias("created_at"),
        (F.lit("2024-01-02").cast("timestamp") + F.make_interval(days=F.col("n_nationkey"))).alias("expires_at"))
    return rows.unionByName(n)


def alert_rules(s, d):
    """The default rules and one score rule per nation."""
    base = s.createDataFrame(
        [(n, t, c, sev, True) for n, t, c, sev, _ in rules.DEFAULT_ALERT_RULES],
        "name string, rule_type string, conditions string, severity_threshold string, is_active boolean")
    more = v.table(s, d, "nation").select(
        F.concat(F.lit("score rule "), F.col("n_nationkey").cast("string")).alias("name"), F.lit("risk_threshold").alias("rule_type"),
        F.concat(F.lit('{"min_risk_score": '), (F.col("n_nationkey") / 2).cast("string"), F.lit("}")).alias("conditions"),
        F.lit("low").alias("severity_threshold"), (F.col("n_nationkey") % 4 != 3).alias("is_active"))
    return base.unionByName(more)


QUERIES = {
    "pattern_brute_force": lambda s, d: flat(op.pattern_brute_force(v.v_threat(s, d), hours=HOURS, threshold=3), *PATTERN),
    "pattern_ddos": lambda s, d: flat(op.pattern_ddos(v.v_threat(s, d), hours=None, threshold=2), *PATTERN),
    "pattern_port_scan": lambda s, d: flat(op.pattern_port_scan(v.v_threat(s, d), hours=HOURS, threshold=3), *PATTERN),
    "pattern_suspicious": lambda s, d: flat(op.pattern_suspicious(v.v_threat(s, d)), *PATTERN),
    "pattern_anomalous": lambda s, d: flat(op.pattern_anomalous(v.v_threat(s, d)), *PATTERN),
    "pattern_union_recent": lambda s, d: flat(
        op.pattern_union_recent(v.v_threat(s, d), hours=HOURS, thresholds=THRESHOLDS), "pattern_type", "source_ips", "event_count", "confidence_score"),
    "pattern_members": lambda s, d: flat(
        op.pattern_members(v.v_threat(s, d), op.pattern_union_recent(v.v_threat(s, d), hours=HOURS, thresholds=THRESHOLDS), hours=HOURS, max_ddos=50)),
    "pattern_persist_first": lambda s, d: flat(
        op.pattern_persist_first(
            op.pattern_union_recent(v.v_threat(s, d), hours=HOURS, thresholds=THRESHOLDS),
            v.v_threat(s, d).where("threat_type = 'port_scan'").groupBy(F.lit("port_scan").alias("pattern_type"))
            .agg(F.lit("active").alias("status")),
        ),
        "pattern_type", "pattern_key", "event_count", "status"),
    "classify_threat_text": lambda s, d: flat(
        op.classify_threat_text(words(s, d)[0]), "id", "class", "class_confidence", "class_severity", "match_score"),
    "classify_threat_text_documents": lambda s, d: flat(
        op.classify_threat_text(words(s, d)[1]), "id", "class", "class_confidence", "class_severity", "match_score"),
    "classify_summary": lambda s, d: flat(op.classify_summary(rich(s, d), last_n=100)),
    "sequence_detect": lambda s, d: flat(op.sequence_detect(rich(s, d), hours=48)),
    "sequence_detect_by_ip": lambda s, d: flat(op.sequence_detect(rich(s, d), hours=HOURS, by="source_ip")),
    "predict_next_threat": lambda s, d: flat(op.predict_next_threat(rich(s, d).where("threat_type IN ('port_scan', 'brute_force')"))),
    "predict_next_threat_oldest": lambda s, d: flat(op.predict_next_threat(rich(s, d).where("threat_type <> 'anomaly'"), last_n=60, order="oldest")),
    "incident_create": lambda s, d: flat(
        op.incident_create(v.v_threat(s, d)), "incident_id", "title", "description", "severity", "status", "priority", "threat_ids",
        "ioc_ids", "created_at AS ts"),
    "alert_candidates": lambda s, d: flat(al.alert_candidates(v.v_threat(s, d)), "id", "risk_score"),
    "alert_candidates_short": lambda s, d: flat(al.alert_candidates(v.v_threat(s, d), policy="short"), "id", "risk_score"),
    "alert_rules_eval": lambda s, d: flat(al.alert_rules_eval(v.v_threat(s, d), alert_rules(s, d))),
    "alert_suppress": lambda s, d: flat(al.alert_suppress(al.alert_candidates(v.v_threat(s, d)), suppressions(s, d)), "id"),
    "alert_summary": lambda s, d: flat(al.alert_summary(v.v_threat(s, d))),
}

LAST = "(SELECT max(ts) FROM v_threat)"


def per_ip(name: str, kind: str, threshold: int, confidence: str, ports: str, text: str, hours: int) -> str:
    return f"""SELECT '{name}' AS pattern_type, source_ip AS source_ips, '{ports}' AS target_ports, {day('min(ts)')} AS start_time,
        {day('max(ts)')} AS end_time, count(*) AS event_count, round(least({confidence}, 0.95e0), 6) AS confidence_score, {text} AS description
      FROM v_threat WHERE threat_type = '{kind}' AND ts >= {LAST} - INTERVAL {hours} HOUR GROUP BY source_ip HAVING count(*) >= {threshold}"""


def ports(values) -> str:
    return "|".join(map(str, values))


def brute(t, hours):
    return per_ip("brute_force", "brute_force", t, "count(*) / 10e0", "22|3389|445",
                  "'Brute force attack detected from ' || source_ip || ' with ' || count(*) || ' failed attempts'", hours)


def scan(t, hours):
    return per_ip("port_scan", "port_scan", t, "count(*) / 20e0", ports(range(1, 100)),
                  "'Port scan detected from ' || source_ip || ' targeting ' || count(*) || ' ports/services'", hours)


def suspicious(hours):
    return per_ip("suspicious_activity", "suspicious_pattern", 1, "count(*) * 0.2e0", "80|443",
                  "'Repeated suspicious activity detected from ' || source_ip || ' with ' || count(*) || ' occurrence(s)'", hours)


def anomalous(hours):
    return per_ip("anomalous_behavior", "anomaly", 1, "count(*) * 0.25e0", "",
                  "'Anomalous behavior cluster detected from ' || source_ip || ' with ' || count(*) || ' anomaly/anomalies'", hours)


def ddos(t: int, hours: int) -> str:
    return f"""SELECT 'ddos' AS pattern_type, array_to_string(list_slice(list_sort(list(DISTINCT source_ip)), 1, 10), '|') AS source_ips,
        '80|443|8080' AS target_ports, {day('min(ts)')} AS start_time, {day('max(ts)')} AS end_time, count(*) AS event_count,
        round(least(count(*) / 200e0, 0.95e0), 6) AS confidence_score,
        'DDoS attack detected with ' || count(*) || ' requests from ' || count(DISTINCT source_ip) || ' sources' AS description
      FROM v_threat WHERE threat_type = 'ddos' AND ts >= {LAST} - INTERVAL {hours} HOUR GROUP BY date_trunc('minute', ts) HAVING count(*) >= {t}"""


UNION = " UNION ALL ".join(f"({q})" for q in (brute(3, HOURS), ddos(2, HOURS), scan(3, HOURS), suspicious(HOURS), anomalous(HOURS)))
KEYED = f"""keyed AS (
  SELECT id, source_ip, ts, CASE threat_type WHEN 'suspicious_pattern' THEN 'suspicious_activity' WHEN 'anomaly' THEN 'anomalous_behavior' ELSE threat_type END AS pattern_type,
    CASE WHEN threat_type = 'ddos' THEN strftime(ts, '%Y-%m-%d %H:%M') ELSE source_ip END AS pattern_key
  FROM v_threat WHERE ts >= {LAST} - INTERVAL {HOURS} HOUR),
sized AS (SELECT *, count(*) OVER (PARTITION BY pattern_type, pattern_key) AS n, min(ts) OVER (PARTITION BY pattern_type, pattern_key) AS first,
  row_number() OVER (PARTITION BY pattern_type, pattern_key ORDER BY id) AS rn FROM keyed),
big AS (SELECT * FROM sized WHERE n >= CASE pattern_type WHEN 'brute_force' THEN 3 WHEN 'ddos' THEN 2 WHEN 'port_scan' THEN 3 ELSE 1 END)"""


def class_sql(text: str, kind: str, source: str, extra: str = "") -> str:
    """One row per id with the best class."""
    options = []
    for order, (name, keywords, indicators, severity, base) in enumerate(rules.THREAT_CLASSES):
        score = " + ".join(
            [f"(CASE WHEN contains(lower({text}), '{w}') OR contains(lower({kind}), '{w}') THEN 1 ELSE 0 END)" for w in keywords]
            + [f"(CASE WHEN contains(lower({text}), '{w}') THEN 2 ELSE 0 END)" for w in indicators])
        options.append(f"SELECT id, {order} AS o, '{name}' AS class, '{severity}' AS sev, CAST({score} AS BIGINT) AS m, {len(keywords)} AS k, {base}e0 AS b FROM {source}")
    return f"""opt AS ({' UNION ALL '.join(options)}),
conf AS (SELECT *, least(m * 1e0 / k * b, 0.99e0) AS c FROM opt),
best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY c DESC, o) AS rn FROM conf WHERE c > 0.3),
classed AS (SELECT s.id{extra}, coalesce(class, 'unknown') AS class, coalesce(c, 0.5e0) AS class_confidence, coalesce(sev, 'medium') AS class_severity,
  coalesce(m, 0) AS match_score FROM {source} s LEFT JOIN best ON best.id = s.id AND rn = 1)"""


RICH = "v_rich AS (SELECT * REPLACE (description || CASE threat_type " + " ".join(
    f"WHEN '{k}' THEN '{t}'" for k, t in MORE_WORDS.items()) + " END AS description) FROM v_threat)"
CLASSED = RICH + ", " + class_sql("description", "threat_type", "v_rich", ", s.ts, s.source_ip")
PLAIN = class_sql("description", "threat_type", "v_threat", ", s.ts, s.source_ip")
SEQ = "seqs AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{name}', {steps!r}, '{severity}')" for i, (name, steps, severity) in enumerate(rules.ATTACK_SEQUENCES)
) + ") AS t(o, sequence_type, steps, severity))"


def sequences(by: str, hours: int) -> str:
    key = "source_ip, " if by else ""
    group = "GROUP BY source_ip" if by else ""
    return threat(f"""{', ' + CLASSED}, {SEQ},
        seen AS (SELECT {key} list(DISTINCT class) AS seen FROM classed WHERE ts >= {LAST} - INTERVAL {hours} HOUR {group})
        SELECT {key} sequence_type, round(len(list_intersect(steps, seen)) * 1e0 / len(steps), 6) AS confidence,
          array_to_string(list_sort(list_intersect(steps, seen)), '|') AS matched_patterns, severity
        FROM seen, seqs WHERE len(list_intersect(steps, seen)) >= 2""")


def predict(chosen: str) -> str:
    advice = " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in rules.NEXT_THREAT_ADVICE.items())
    return threat(f"""{', ' + CLASSED}, {SEQ},
        five AS ({chosen}),
        seen AS (SELECT list(DISTINCT class) AS seen, count(*) AS n FROM five),
        tried AS (SELECT *, list_max(list_transform(range(1, len(steps) + 1), lambda i: CASE WHEN list_contains(seen, steps[i]) THEN i ELSE 0 END)) AS furthest
          FROM seen, seqs WHERE n >= 3 AND len(list_intersect(steps, seen)) >= 2)
        SELECT steps[furthest + 1] AS predicted_threat, 0.75e0 AS confidence, sequence_type AS based_on_sequence,
          CASE steps[furthest + 1] {advice} ELSE 'Monitor system activity closely' END AS recommendation
        FROM tried WHERE furthest < len(steps) ORDER BY o LIMIT 1""")


LEVEL = "CASE WHEN risk_score >= 8 THEN 'CRITICAL' WHEN risk_score >= 6 THEN 'HIGH' WHEN risk_score >= 4 THEN 'MEDIUM' WHEN risk_score >= 2 THEN 'LOW' ELSE 'INFO' END"
CANDIDATE = "(risk_score >= 6 OR (threat_type IN ('brute_force', 'suspicious_pattern') AND risk_score >= 5))"
TITLE = "CASE threat_type WHEN 'brute_force' THEN 'Brute Force' WHEN 'port_scan' THEN 'Port Scan' WHEN 'suspicious_pattern' THEN 'Suspicious Pattern' WHEN 'anomaly' THEN 'Anomaly' ELSE 'Ddos' END"

ORACLE = {
    "pattern_brute_force": threat(brute(3, HOURS)),
    "pattern_ddos": threat(ddos(2, 10000)),
    "pattern_port_scan": threat(scan(3, HOURS)),
    "pattern_suspicious": threat(suspicious(24)),
    "pattern_anomalous": threat(anomalous(24)),
    "pattern_union_recent": threat(f"SELECT pattern_type, source_ips, event_count, confidence_score FROM ({UNION})"),
    "pattern_members": threat(f", {KEYED} SELECT pattern_type, pattern_key, id AS threat_id FROM big WHERE pattern_type <> 'ddos' OR rn <= 50"),
    "pattern_persist_first": threat(f""", {KEYED}
        SELECT pattern_type, min_by(pattern_key, (first, pattern_key)) AS pattern_key, min_by(n, (first, pattern_key)) AS event_count, 'active' AS status
        FROM big WHERE pattern_type <> 'port_scan' GROUP BY pattern_type"""),
    "classify_threat_text": threat(f", {PLAIN} SELECT id, class, round(class_confidence, 6) AS class_confidence, class_severity, match_score FROM classed"),
    "classify_threat_text_documents": "WITH src AS (SELECT doc_id AS id, text, source FROM documents), " + class_sql("text", "source", "src")
        + " SELECT id, class, round(class_confidence, 6) AS class_confidence, class_severity, match_score FROM classed",
    "classify_summary": threat(f"""{', ' + CLASSED}, c AS (SELECT * FROM classed ORDER BY ts DESC, id DESC LIMIT 100)
        SELECT 'class' AS section, class AS key, count(*) AS n, -1e0 AS value FROM c GROUP BY class
        UNION ALL SELECT 'severity', class_severity, count(*), -1e0 FROM c GROUP BY class_severity
        UNION ALL SELECT 'total', 'average_confidence', count(*), round(avg(class_confidence), 3) FROM c"""),
    "sequence_detect": sequences("", 48),
    "sequence_detect_by_ip": sequences("source_ip", HOURS),
    "predict_next_threat": predict("SELECT * FROM classed WHERE class IN ('reconnaissance', 'brute_force') ORDER BY ts DESC, id DESC LIMIT 5"),
    "predict_next_threat_oldest": predict("SELECT * FROM (SELECT * FROM classed WHERE class <> 'malware' ORDER BY ts DESC, id DESC LIMIT 60) ORDER BY ts, id LIMIT 5"),
    "incident_create": threat(f"""
        SELECT 'INC-' || strftime(ts, '%Y%m%d') || '-' || upper(substr(md5(CAST(id AS VARCHAR)), 1, 8)) AS incident_id,
          {TITLE} || ' from ' || source_ip AS title, description, CASE WHEN risk_score >= 7 THEN 'high' ELSE 'medium' END AS severity,
          'open' AS status, CAST(CASE WHEN risk_score >= 7 THEN 1 ELSE 2 END AS BIGINT) AS priority, CAST(id AS VARCHAR) AS threat_ids,
          source_ip AS ioc_ids, {day('ts')} AS ts FROM v_threat WHERE risk_score >= 5"""),
    "alert_candidates": threat(f"SELECT id, risk_score FROM v_threat WHERE {CANDIDATE}"),
    "alert_candidates_short": threat("SELECT id, risk_score FROM v_threat WHERE risk_score >= 7"),
    "alert_rules_eval": threat(f"""
        , r AS (SELECT 'score rule ' || n_nationkey AS name, n_nationkey / 2e0 AS low, 'low' AS sev FROM nation WHERE n_nationkey % 4 <> 3
          UNION ALL SELECT 'High Risk Threat Alert', 7e0, 'high')
        SELECT name, 'risk_threshold' AS rule_type, sev AS severity_threshold, count(id) AS matches, coalesce({day('max(ts)')}, '') AS last_match, count(id) >= 1 AS triggered
        FROM r LEFT JOIN v_threat ON risk_score >= low GROUP BY name, sev
        UNION ALL SELECT 'Brute Force Detection', 'pattern_match', 'critical', count(*), {day('max(ts)')}, count(*) >= 5 FROM v_threat WHERE threat_type = 'brute_force'"""),
    "alert_suppress": threat(f"""
        SELECT id FROM v_threat WHERE {CANDIDATE}
          AND NOT (user_id % 34 = 0 AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20')
          AND NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey % 2 = 0
            AND ts BETWEEN TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * n_nationkey AND TIMESTAMP '2024-01-02' + INTERVAL 1 DAY * n_nationkey
            AND CASE WHEN n_nationkey < 10 THEN contains(description, 'code 1' || n_nationkey) ELSE threat_type = 'anomaly' END)"""),
    "alert_summary": threat(f"""
        , t AS (SELECT *, {LEVEL} AS level FROM v_threat)
        SELECT 'type' AS section, row_number() OVER (ORDER BY count(*) DESC, threat_type) AS position, threat_type AS key, count(*) AS n, -1e0 AS score FROM t GROUP BY threat_type
        UNION ALL SELECT 'level', row_number() OVER (ORDER BY CASE level WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END), level, count(*), -1e0 FROM t WHERE level <> 'INFO' GROUP BY level
        UNION ALL (SELECT 'top_ip', row_number() OVER (ORDER BY count(*) DESC, source_ip) AS p, source_ip, count(*), -1e0 FROM t GROUP BY source_ip QUALIFY p <= 5)
        UNION ALL (SELECT 'critical', row_number() OVER (ORDER BY ts, id) AS p, threat_type || ' from ' || source_ip, 1, risk_score FROM t WHERE level = 'CRITICAL' QUALIFY p <= 3)
        UNION ALL (SELECT 'top_score', row_number() OVER (ORDER BY risk_score DESC, id) AS p, threat_type || ' from ' || source_ip, 1, risk_score FROM t QUALIFY p <= 5)"""),
}

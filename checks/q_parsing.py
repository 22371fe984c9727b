"""Sources, parsing and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.shape import flat
from checks.sqlviews import V_EVENT, V_LOG_RAW, day, log, threat, with_views
from logwarden.operators import parsing as op
from logwarden.plans import views as v

QUERIES = {
    "parse_log_lines": lambda s, d: flat(
        op.parse_log_lines(v.v_log_raw(s, d).select(F.col("event_id").alias("id"), F.col("raw").alias("raw_log")), as_of=v.AS_OF_YEAR),
        "id", "log_type", "ip", "timestamp AS ts", "method", "url", "status", "size", "protocol", "port", "action",
        "suspicious_patterns AS tags", "is_private_ip",
    ),
    "parse_timestamps": lambda s, d: flat(
        op.parse_timestamps(
            v.table(s, d, "events").select(
                "event_id",
                F.when(F.col("event_id") % 6 == 0, F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss' +0200'"))
                .when(F.col("event_id") % 6 == 1, F.date_format("ts", "MMM dd HH:mm:ss"))
                .when(F.col("event_id") % 6 == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
                .when(F.col("event_id") % 6 == 3, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
                .when(F.col("event_id") % 6 == 4, F.lit("no time"))
                .otherwise(F.date_format("ts", "MMM d HH:mm:ss")).alias("time_text"),
            ),
            as_of="2024-01-15 12:00:00",
        ),
        "event_id", "timestamp AS ts",
    ),
    "tag_suspicious_patterns": lambda s, d: flat(
        op.tag_suspicious_patterns(v.table(s, d, "documents"), "text"), "doc_id", "suspicious_patterns AS tags"),
    "tag_suspicious_patterns_pages": lambda s, d: flat(
        op.tag_suspicious_patterns(v.table(s, d, "pages"), "html"), "page_id", "suspicious_patterns AS tags"),
    "classify_private_ip": lambda s, d: flat(
        op.classify_private_ip(
            v.table(s, d, "events").select(
                "event_id",
                # addresses all over the number range, some with an octet that is too large
                F.concat_ws(
                    ".", F.pmod(F.col("event_id") * 7, F.lit(260)), F.pmod(F.col("event_id") * 31, F.lit(256)),
                    F.pmod(F.col("event_id") * 13, F.lit(256)), F.pmod(F.col("event_id") * 3, F.lit(256)),
                ).alias("source_ip"),
            )
        ),
        "event_id", "source_ip", "is_private_ip",
    ),
    "extract_first_ip": lambda s, d: flat(
        op.extract_first_ip(v.table(s, d, "documents"), "text").where("first_ip IS NOT NULL"), "doc_id", "first_ip"),
    "normalize_log_entry": lambda s, d: flat(
        v.v_log(s, d), "id", "timestamp AS ts", "ingested_at", "source_ip", "destination_port AS port", "protocol", "action",
        "raw_log AS raw", "parsed_data.log_type", "parsed_data.method", "parsed_data.url", "parsed_data.status",
        "parsed_data.size", "parsed_data.suspicious_patterns AS tags", "parsed_data.is_private_ip",
    ),
    "flag_failed_attempt": lambda s, d: flat(op.flag_failed_attempt(v.v_log(s, d)), "id", "is_failed_attempt"),
    "flag_port_scan_attempt": lambda s, d: flat(op.flag_port_scan_attempt(v.v_log(s, d)), "id", "is_port_scan_attempt"),
    "firewall_verdict": lambda s, d: flat(
        # the action comes from the operator alone
        op.firewall_verdict(v.v_log(s, d).select("id", "raw_log", "parsed_data.log_type", F.lit("none").alias("action"))).where("log_type = 'firewall'"),
        "id", "action"),
    "indicator_type": lambda s, d: flat(
        op.indicator_type(
            v.table(s, d, "pages").select("page_id", F.col("url").alias("indicator"))
            .unionByName(v.table(s, d, "pages").select("page_id", F.md5("url").alias("indicator")))
            .unionByName(v.table(s, d, "pages").select("page_id", F.concat(F.lit("10.0.0."), "page_id").alias("indicator")))
        ),
        "page_id", "indicator", "indicator_type",
    ),
    "risk_level_bands": lambda s, d: flat(
        op.risk_level_bands(
            v.v_threat(s, d)
            .withColumn("a", op.ladder(F.col("risk_score"), op.rules.BANDS["listing"]))
            .withColumn("b", op.ladder(F.col("risk_score"), op.rules.BANDS["timeline"]))
            .withColumn("c", op.ladder(F.col("risk_score"), op.rules.BANDS["explain"]))
        ),
        "id", "risk_level", "a AS listing_level", "b AS timeline_level", "c AS explain_level",
    ),
    "entry_features": lambda s, d: flat(op.entry_features(v.v_log(s, d)), "id", *op.ENTRY_FEATURES),
}

PRIVATE_SQL = """
  n BETWEEN 0 AND 16777215 OR n // 16777216 = 10 OR n // 16777216 = 127 OR n // 65536 = 169 * 256 + 254
  OR n // 1048576 = 172 * 16 + 1 OR (n // 256 = 192 * 65536 AND n % 256 NOT IN (9, 10))
  OR n // 256 = 192 * 65536 + 2 OR n // 65536 = 192 * 256 + 168 OR n // 131072 = 198 * 128 + 9
  OR n // 256 = 198 * 65536 + 51 * 256 + 100 OR n // 256 = 203 * 65536 + 113 OR n >= 4026531840"""


def tags_sql(text: str) -> str:
    return f"""array_to_string(list_filter([
      CASE WHEN regexp_matches({text}, '(?i)(union|select|insert|update|delete|drop|exec|script)') THEN 'sql_injection' END,
      CASE WHEN regexp_matches({text}, '(?i)(<script|javascript:|onload=|onerror=)') THEN 'xss' END,
      CASE WHEN regexp_matches({text}, '(\\.\\./|\\.\\.\\\\|%2e%2e%2f)') THEN 'path_traversal' END,
      CASE WHEN regexp_matches({text}, '(?i)(;|\\||&|`|\\$\\(|\\$\\{{)') THEN 'command_injection' END,
      CASE WHEN regexp_matches({text}, '(?i)(admin|root|test|guest|user|login|password)') THEN 'brute_force_indicators' END
    ], lambda x: x IS NOT NULL), '|')"""


def bands_sql(column: str, bands) -> str:
    whens = " ".join(f"WHEN {column} >= {low}e0 THEN '{label}'" for low, label in bands if low is not None)
    return f"CASE {whens} ELSE '{bands[-1][1]}' END"


ORACLE = {
    "parse_log_lines": log(f"""
        SELECT id, log_type, source_ip AS ip, {day('ts')} AS ts, method, url, status, size, protocol,
          coalesce(CAST(port AS VARCHAR), '') AS port, action, array_to_string(tags, '|') AS tags,
          user_id % 4 <> 3 AS is_private_ip FROM v_log"""),
    "parse_timestamps": f"""
        SELECT event_id, {day('t')} AS ts FROM (
          SELECT event_id, CASE event_id % 6
            WHEN 0 THEN date_trunc('second', ts) - INTERVAL 2 HOUR
            WHEN 4 THEN TIMESTAMP '2024-01-15 12:00:00'
            WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('second', ts)
            ELSE CASE WHEN date_trunc('second', ts) <= TIMESTAMP '2024-01-15 12:00:00' THEN date_trunc('second', ts)
                 ELSE date_trunc('second', ts) - INTERVAL 1 YEAR END END AS t
          FROM events)""",
    "tag_suspicious_patterns": f"SELECT doc_id, {tags_sql('text')} AS tags FROM documents",
    "tag_suspicious_patterns_pages": f"SELECT page_id, {tags_sql('html')} AS tags FROM pages",
    "classify_private_ip": f"""
        SELECT event_id, source_ip, a < 256 AND ({PRIVATE_SQL}) AS is_private_ip FROM (
          SELECT event_id, event_id * 7 % 260 AS a, (event_id * 7 % 260) || '.' || (event_id * 31 % 256) || '.'
             || (event_id * 13 % 256) || '.' || (event_id * 3 % 256) AS source_ip,
             (event_id * 7 % 260) * 16777216 + (event_id * 31 % 256) * 65536 + (event_id * 13 % 256) * 256
             + event_id * 3 % 256 AS n FROM events)""",
    "extract_first_ip": r"""
        SELECT doc_id, regexp_extract(text, '(\d+\.\d+\.\d+\.\d+)', 1) AS first_ip FROM documents
        WHERE regexp_matches(text, '\d+\.\d+\.\d+\.\d+')""",
    "normalize_log_entry": log(f"""
        SELECT id, {day('ts')} AS ts, {day('ingested_at')} AS ingested_at, source_ip, CAST(coalesce(port, -1) AS BIGINT) AS port,
          protocol, action, raw, log_type, method, url, status, size, array_to_string(tags, '|') AS tags,
          user_id % 4 <> 3 AS is_private_ip FROM v_log"""),
    "flag_failed_attempt": log("""
        SELECT id, event_type IN ('error', 'click') OR (event_type = 'purchase' AND k % 5 <> 0)
          OR (event_type = 'view' AND k % 10 = 0) AS is_failed_attempt FROM v_log"""),
    "flag_port_scan_attempt": log("SELECT id, event_type = 'purchase' AND k % 5 <> 0 AS is_port_scan_attempt FROM v_log"),
    "firewall_verdict": log("""
        SELECT id, CASE WHEN k % 5 = 0 THEN 'accept' ELSE 'drop' END AS action FROM v_log WHERE event_type = 'purchase'"""),
    "indicator_type": """
        SELECT page_id, url AS indicator, 'domain' AS indicator_type FROM pages
        UNION ALL SELECT page_id, md5(url), 'hash' FROM pages
        UNION ALL SELECT page_id, '10.0.0.' || page_id, 'ip' FROM pages""",
    "risk_level_bands": threat(f"""
        SELECT id, {bands_sql('risk_score', [(8.0, 'CRITICAL'), (6.0, 'HIGH'), (4.0, 'MEDIUM'), (2.0, 'LOW'), (None, 'INFO')])} AS risk_level,
          {bands_sql('risk_score', [(7.0, 'HIGH'), (4.0, 'MEDIUM'), (None, 'LOW')])} AS listing_level,
          {bands_sql('risk_score', [(7.0, 'critical'), (4.0, 'high'), (2.0, 'medium'), (None, 'low')])} AS timeline_level,
          {bands_sql('risk_score', [(9.0, 'CRITICAL'), (7.0, 'HIGH'), (4.0, 'MEDIUM'), (None, 'LOW')])} AS explain_level
        FROM v_threat"""),
    "entry_features": log("""
        SELECT id, CAST(hour(ts) AS DOUBLE) AS f_hour, CAST(minute(ts) AS DOUBLE) AS f_minute,
          CAST(isodow(ts) - 1 AS DOUBLE) AS f_weekday, CAST(coalesce(port, 0) AS DOUBLE) AS f_port,
          CAST(protocol = 'TCP' AS DOUBLE) AS f_tcp, CAST(protocol = 'UDP' AS DOUBLE) AS f_udp, 0e0 AS f_icmp,
          CAST(action = 'drop' AS DOUBLE) AS f_denied, CAST(len(tags) AS DOUBLE) AS f_tags FROM v_log"""),
}

"""The same views in SQL, derived straight from the tables (no line is parsed here)."""

V_EVENT = """
v_event AS (
  SELECT event_id, user_id, event_type, value,
         date_trunc('second', ts) AS ts,
         CAST(json_extract_string(props, '$.k') AS INT) AS k,
         (CASE user_id % 4 WHEN 0 THEN '192.168.' WHEN 1 THEN '10.0.' WHEN 2 THEN '172.16.' ELSE '45.33.' END)
           || (user_id // 256) || '.' || (user_id % 256) AS ip
  FROM events)"""

V_LOG_RAW = V_EVENT + """,
v_log_raw AS (
  SELECT *, CASE event_type
    WHEN 'view' THEN ip || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET /page/' || k
       || ' HTTP/1.1" ' || (CASE WHEN k % 10 = 0 THEN 404 ELSE 200 END) || ' ' || (200 + k)
    WHEN 'click' THEN ip || ' - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET '
       || (CASE k % 6 WHEN 0 THEN '/search?q=UNION SELECT' WHEN 1 THEN '/search?q=<script>'
           WHEN 2 THEN '/../../etc/passwd' WHEN 3 THEN '/run;ls' WHEN 4 THEN '/wp-admin' ELSE '/about' END)
       || ' HTTP/1.1" 403 ' || k
    WHEN 'error' THEN strftime(ts, '%b %d %H:%M:%S') || ' server sshd[' || event_id || ']: Failed password for user from '
       || ip || ' port ' || (k + 40000) || ' ssh2'
    WHEN 'signup' THEN strftime(ts, '%b %d %H:%M:%S') || ' server sshd[' || event_id || ']: Accepted password for user from '
       || ip || ' port ' || (k + 40000) || ' ssh2'
    ELSE strftime(ts, '%b %d %H:%M:%S') || ' firewall kernel: [UFW ' || (CASE WHEN k % 5 = 0 THEN 'ALLOW' ELSE 'BLOCK' END)
       || '] IN=eth0 OUT= SRC=' || ip || ' DST=10.0.0.1 LEN=60 PROTO=' || (CASE WHEN k % 3 = 0 THEN 'UDP' ELSE 'TCP' END)
       || ' SPT=45678 DPT=' || (20 + k) END AS raw
  FROM v_event)"""

V_LOG = V_LOG_RAW + """,
v_log AS (
  SELECT event_id AS id, ts, ts + INTERVAL 1 HOUR * (event_id % 48) AS ingested_at, ip AS source_ip,
    CASE WHEN event_type = 'purchase' THEN 20 + k END AS port,
    CASE WHEN event_type = 'purchase' THEN (CASE WHEN k % 3 = 0 THEN 'UDP' ELSE 'TCP' END) ELSE '' END AS protocol,
    CASE event_type WHEN 'purchase' THEN (CASE WHEN k % 5 = 0 THEN 'accept' ELSE 'drop' END)
      WHEN 'error' THEN 'Failed' WHEN 'signup' THEN 'Accepted' ELSE '' END AS action,
    raw,
    CASE event_type WHEN 'purchase' THEN 'firewall' WHEN 'error' THEN 'ssh_auth' WHEN 'signup' THEN 'ssh_auth'
      ELSE 'apache_access' END AS log_type,
    CASE WHEN event_type IN ('view', 'click') THEN 'GET' ELSE '' END AS method,
    CASE event_type WHEN 'view' THEN '/page/' || k || ' HTTP/1.1'
      WHEN 'click' THEN (CASE k % 6 WHEN 0 THEN '/search?q=UNION SELECT' WHEN 1 THEN '/search?q=<script>'
           WHEN 2 THEN '/../../etc/passwd' WHEN 3 THEN '/run;ls' WHEN 4 THEN '/wp-admin' ELSE '/about' END) || ' HTTP/1.1'
      ELSE '' END AS url,
    CASE event_type WHEN 'view' THEN (CASE WHEN k % 10 = 0 THEN '404' ELSE '200' END) WHEN 'click' THEN '403' ELSE '' END AS status,
    CASE event_type WHEN 'view' THEN CAST(200 + k AS VARCHAR) WHEN 'click' THEN CAST(k AS VARCHAR) ELSE '' END AS size,
    k, user_id, event_type,
    list_filter([
      CASE WHEN regexp_matches(raw, '(?i)(union|select|insert|update|delete|drop|exec|script)') THEN 'sql_injection' END,
      CASE WHEN regexp_matches(raw, '(?i)(<script|javascript:|onload=|onerror=)') THEN 'xss' END,
      CASE WHEN regexp_matches(raw, '(\\.\\./|\\.\\.\\\\|%2e%2e%2f)') THEN 'path_traversal' END,
      CASE WHEN regexp_matches(raw, '(?i)(;|\\||&|`|\\$\\(|\\$\\{)') THEN 'command_injection' END,
      CASE WHEN regexp_matches(raw, '(?i)(admin|root|test|guest|user|login|password)') THEN 'brute_force_indicators' END
    ], lambda x: x IS NOT NULL) AS tags
  FROM v_log_raw)"""

V_THREAT = V_EVENT + """,
v_threat AS (
  SELECT event_id AS id,
    CASE event_type WHEN 'error' THEN 'brute_force' WHEN 'purchase' THEN 'port_scan' WHEN 'click' THEN 'suspicious_pattern'
      WHEN 'signup' THEN 'anomaly' ELSE 'ddos' END AS threat_type,
    ip AS source_ip, least(10e0, value / 10e0) AS risk_score,
    (CASE event_type WHEN 'error' THEN 'brute_force' WHEN 'purchase' THEN 'port_scan' WHEN 'click' THEN 'suspicious_pattern'
      WHEN 'signup' THEN 'anomaly' ELSE 'ddos' END) || ' seen with code ' || k AS description,
    ts, ts + INTERVAL 1 HOUR * (event_id % 48) AS ingested_at,
    CASE WHEN event_id % 5 = 0 THEN 'resolved' ELSE 'active' END AS status, k, user_id
  FROM v_event)"""

V_IOC = """
v_ioc AS (
  SELECT user_id AS id, 'ip' AS ioc_type, ip AS value, min(ts) AS created_at, user_id % 2 = 0 AS is_active
  FROM v_event WHERE user_id % 17 = 0 GROUP BY ip, user_id)"""

V_PLACE = """
v_place AS (
  SELECT n_nationkey AS nation, n_name AS country, 'City ' || n_nationkey AS city, n_nationkey * 2e0 AS latitude,
    n_nationkey * 3e0 AS longitude,
    CASE n_nationkey % 5 WHEN 0 THEN 'CN' WHEN 1 THEN 'RU' WHEN 2 THEN 'PK' WHEN 3 THEN 'US' ELSE 'DE' END AS country_code
  FROM nation)"""

# place of every address of the events table: exact row, private place, block, unknown
V_GEO = V_PLACE + """,
v_ip AS (SELECT DISTINCT ip, user_id FROM v_event),
v_digit AS (SELECT ip, user_id, md5(ip) AS h FROM v_ip),
v_hash AS (
  SELECT ip, user_id,
    list_sum(list_transform(range(1, 33), lambda i: instr('0123456789abcdef', h[i]) - 1)) % 5 AS idx
  FROM v_digit),
v_private AS (
  SELECT * FROM (VALUES (0, 'United States', 'New York', 40.7128e0, -74.0060e0, 'US'), (1, 'France', 'Paris', 48.8566e0, 2.3522e0, 'FR'),
    (2, 'South Korea', 'Seoul', 37.5665e0, 126.9780e0, 'KR'), (3, 'Canada', 'Toronto', 43.6532e0, -79.3832e0, 'CA'),
    (4, 'Ukraine', 'Kyiv', 50.4501e0, 30.5234e0, 'UA')) AS t(idx, country, city, latitude, longitude, country_code)),
v_geo AS (
  SELECT v_hash.ip,
    coalesce(e.country, p.country, b.country, w.country, 'Unknown') AS country,
    coalesce(e.city, p.city, b.city, w.city, 'Unknown') AS city,
    coalesce(e.latitude, p.latitude, b.latitude, w.latitude, 0e0) AS latitude,
    coalesce(e.longitude, p.longitude, b.longitude, w.longitude, 0e0) AS longitude,
    coalesce(e.country_code, p.country_code, b.country_code, w.country_code, 'XX') AS country_code
  FROM v_hash
  LEFT JOIN v_place e ON v_hash.user_id % 8 = 3 AND e.nation = v_hash.user_id % 25
  LEFT JOIN v_private p ON v_hash.user_id % 4 <> 3 AND p.idx = v_hash.idx
  LEFT JOIN v_place b ON v_hash.user_id < 256 AND b.nation % 2 = 0 AND v_hash.user_id % 4 = 3 AND v_hash.user_id // 8 = b.nation
  LEFT JOIN v_place w ON v_hash.user_id % 4 = 3 AND w.nation = 0)"""

V_FEED = """
v_feed AS (
  SELECT ip AS indicator, CAST(sum(CASE WHEN k >= 60 THEN 1 ELSE 0 END) AS BIGINT) AS positives, count(*) AS total,
    CAST(max(user_id) % 101 AS DOUBLE) AS abuse_confidence, count(*) % 30 AS total_reports,
    CASE max(user_id) % 5 WHEN 0 THEN 'CN' WHEN 1 THEN 'RU' WHEN 2 THEN 'PK' WHEN 3 THEN 'US' ELSE 'DE' END AS country,
    'isp ' || (max(user_id) % 7) AS isp, 'Data Center' AS usage_type
  FROM v_event GROUP BY ip)"""

V_CHANGES = """
v_changes AS (
  SELECT event_id AS change_id, (event_id // 14) * 14 AS target_id,
    CASE k % 3 WHEN 0 THEN 'resolved' WHEN 1 THEN 'investigating' ELSE 'false_positive' END AS status,
    ts AS changed_at, 'analyst ' || (k % 4) AS "user"
  FROM v_event WHERE event_id % 7 = 0)"""

V_FLOW = """
v_flow AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
    CASE WHEN l_returnflag = 'R' THEN 'Attack' ELSE 'Normal' END AS attack_type,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_attack,
    l_returnflag || l_linestatus AS flags
  FROM lineitem)"""


def with_views(query: str, *views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n" + query


def log(query: str) -> str:
    return with_views(query, V_LOG)


def threat(query: str, *more: str) -> str:
    return with_views(query, V_THREAT, *more)


def flow(query: str, *more: str) -> str:
    return with_views(query, V_FLOW, *more)


def day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def round_1(x: str) -> str:
    """One decimal on the binary value, ties to even (see common.round_1)."""
    m = f"round(({x}) * 20)"
    side = f"((({x}) * 16 - {m}) + ({x}) * 4)"
    low, high = f"(({m} - 1) / 2)", f"(({m} + 1) / 2)"
    return (
        f"(CASE WHEN abs({m}) % 2 = 1 AND abs({side}) < 1e-6 THEN "
        f"(CASE WHEN {side} > 0 THEN {high} WHEN {side} < 0 THEN {low} WHEN {low} % 2 = 0 THEN {low} ELSE {high} END) / 10e0 "
        f"ELSE round(({x}) * 10e0) / 10e0 END)"
    )

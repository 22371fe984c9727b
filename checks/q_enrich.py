"""Indicator, reputation and location joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.shape import flat
from checks.sqlviews import V_EVENT, V_FEED, V_GEO, V_IOC, V_LOG, V_THREAT, day, threat, with_views
from logwarden.operators import enrich as op
from logwarden.plans import views as v


def indicators(s, d):
    """Every address of the events table, and their hashes, as typed indicators."""
    ips = v.with_ip_and_k(v.table(s, d, "events")).select("ip", "user_id").distinct()
    return ips.select(F.col("ip").alias("indicator"), F.lit("ip").alias("indicator_type")).unionByName(
        ips.select(F.md5("ip").alias("indicator"), F.lit("hash").alias("indicator_type"))
    )


def listed(s, d):
    """Active addresses, plus hashes of some addresses and the hosts of some pages."""
    ips = v.with_ip_and_k(v.table(s, d, "events")).select("ip", "user_id").distinct()
    hashes = ips.where("user_id % 5 = 0").select(
        (F.col("user_id") + 1000000).alias("id"), F.lit("hash").alias("ioc_type"), F.upper(F.md5("ip")).alias("value"),
        F.lit(True).alias("is_active"))
    hosts = v.table(s, d, "pages").where("page_id % 10 = 0").select(
        (F.col("page_id") + 2000000).alias("id"), F.lit("domain").alias("ioc_type"), host("url").alias("value"),
        F.lit(True).alias("is_active"))
    base = v.v_ioc(s, d).where("is_active")
    return base.unionByName(hashes, allowMissingColumns=True).unionByName(hosts, allowMissingColumns=True)


def host(url: str):
    return F.regexp_extract(url, r"^\w+://([^/]+)", 1)


def asked_urls(s, d):
    return v.table(s, d, "pages").select("page_id", F.col("url").alias("indicator"), F.lit("domain").alias("indicator_type"))


def geo(s, d):
    return v.v_geo(s, d), v.v_geo_ranges(s, d)


def batch(s, d):
    ips = v.with_ip_and_k(v.table(s, d, "events")).select(F.col("ip").alias("indicator")).distinct()
    return ips.unionByName(v.table(s, d, "pages").select(F.col("url").alias("indicator")).distinct())


QUERIES = {
    "ioc_exact_match": lambda s, d: flat(op.ioc_exact_match(indicators(s, d), listed(s, d))),
    "ioc_domain_match": lambda s, d: flat(op.ioc_domain_match(asked_urls(s, d), listed(s, d))),
    "ioc_domain_match_long_list": lambda s, d: flat(
        op.contains_join(
            asked_urls(s, d).select("page_id", "indicator"),
            "indicator",
            listed(s, d).where("ioc_type = 'domain'").select(F.col("value").alias("domain")).distinct(),
            "domain",
            shard_chars=4096,
        )
    ),
    "ioc_partial_match": lambda s, d: flat(
        op.ioc_partial_match(
            v.table(s, d, "pages").select("page_id", host("url").alias("indicator")), listed(s, d))),
    "ioc_summary": lambda s, d: flat(op.ioc_summary(listed(s, d))),
    "ioc_maintain": lambda s, d: flat(
        op.ioc_maintain(
            v.v_ioc(s, d).select("id", "ioc_type", "value", "is_active"),
            additions=v.with_ip_and_k(v.table(s, d, "events")).where("user_id % 4 = 0").select(
                (F.col("event_id") + 1000000).alias("id"), F.lit("ip").alias("ioc_type"), F.col("ip").alias("value"),
                F.lit(True).alias("is_active")),
            deactivate=v.v_ioc(s, d).where("id % 3 = 0").select("id"),
        ),
        "ioc_type", "value", "is_active",
    ),
    "ioc_reputation": lambda s, d: flat(
        op.ioc_reputation(
            v.table(s, d, "events").select(F.col("user_id").alias("u")).distinct()
            .select(F.explode(F.array("u", F.col("u") + 256000)).alias("user_id"))
            .transform(lambda x: v.with_ip_and_k(x.withColumn("props", F.lit("{}")))).select(F.col("ip").alias("source_ip")),
            v.v_ioc(s, d),
            v.v_threat(s, d),
        ),
        "source_ip", "reputation", "confidence", "threat_count", "first_seen",
    ),
    "intel_score": lambda s, d: flat(
        op.intel_score(indicators(s, d), listed(s, d), v.v_feed(s, d), require_match=False),
        "indicator", "indicator_type", "overall_score", "sources"),
    "intel_verdict": lambda s, d: flat(
        op.intel_verdict(op.intel_score(indicators(s, d), listed(s, d), v.v_feed(s, d), require_match=False)), "indicator", "verdict"),
    "intel_details": lambda s, d: flat(op.intel_details(op.intel_score(indicators(s, d), listed(s, d), v.v_feed(s, d)))),
    "intel_batch": lambda s, d: flat(
        op.intel_batch(batch(s, d), listed(s, d), v.v_feed(s, d)),
        "indicator", "indicator_type", "overall_score", "verdict", "sources", "category", "reports"),
    "intel_search": lambda s, d: flat(
        op.intel_search(batch(s, d), listed(s, d), v.v_feed(s, d), require_match=False, min_score=20, max_score=95,
                        verdicts=["suspicious", "malicious"], sources=["abuseipdb"]),
        "indicator", "overall_score", "verdict"),
    "threat_hunting": lambda s, d: flat(
        op.threat_hunting(v.v_threat(s, d), v.v_ioc(s, d).where("is_active"), v.v_feed(s, d), require_match=False),
        "threat_id", "source_ip", "overall_score", "priority", "risk_score", "recommendations"),
    "threat_hunting_stats": lambda s, d: flat(
        op.threat_hunting_stats(v.v_threat(s, d), v.v_ioc(s, d).where("is_active"), v.v_feed(s, d), require_match=False)),
    "geo_enrich": lambda s, d: flat(
        op.geo_enrich(v.v_threat(s, d), *geo(s, d)), "id", "source_ip", "country", "city", "latitude", "longitude", "country_code"),
    "geo_top_countries": lambda s, d: flat(op.geo_top_countries(v.v_threat(s, d), *geo(s, d))),
    "geo_top_cities": lambda s, d: flat(op.geo_top_cities(v.v_threat(s, d), *geo(s, d))),
    "blocklist_build": lambda s, d: flat(
        op.blocklist_build(v.v_threat(s, d), v.v_ioc(s, d).withColumn("ioc_type", F.lit("blocked_ip"))),
        "value", "description", "created_at AS ts", "source", "is_active"),
    "blocklist_apply": lambda s, d: flat(
        op.blocklist_apply(v.v_log(s, d), v.v_ioc(s, d).withColumn("ioc_type", F.lit("blocked_ip"))), "id", "source_ip", "is_blocked"),
    "blocklist_apply_drop": lambda s, d: flat(
        op.blocklist_apply(v.v_log(s, d), v.v_ioc(s, d).withColumn("ioc_type", F.lit("blocked_ip")), mode="drop"), "id"),
}

INDICATORS = """
ind AS (SELECT ip AS indicator, 'ip' AS indicator_type, user_id FROM (SELECT DISTINCT ip, user_id FROM v_event)
  UNION ALL SELECT md5(ip), 'hash', user_id FROM (SELECT DISTINCT ip, user_id FROM v_event))"""
HOSTS = r"hosts AS (SELECT DISTINCT lower(regexp_extract(url, '^\w+://([^/]+)', 1)) AS h FROM pages WHERE page_id % 10 = 0)"
IP_LISTED = "(indicator_type = 'ip' AND user_id % 34 = 0)"
LOCAL = f"""local AS (SELECT ind.*, CASE WHEN {IP_LISTED} THEN 'malicious_ip' WHEN indicator_type = 'hash' AND user_id % 5 = 0 THEN 'malware_hash' ELSE '' END AS category,
  CASE WHEN {IP_LISTED} THEN 0.9e0 WHEN indicator_type = 'hash' AND user_id % 5 = 0 THEN 0.95e0 ELSE 0e0 END AS confidence FROM ind)"""
SCORED = f"""scored AS (
  SELECT local.indicator, indicator_type, category, confidence * 100 AS strict,
    greatest(confidence * 100, coalesce(f.positives * 1e0 / f.total * 100, 0e0), CASE WHEN indicator_type = 'ip' THEN coalesce(f.abuse_confidence, 0e0) ELSE 0e0 END) AS loose,
    'local' || (CASE WHEN f.total IS NOT NULL THEN '|virustotal' ELSE '' END)
      || (CASE WHEN f.abuse_confidence IS NOT NULL AND indicator_type = 'ip' THEN '|abuseipdb' ELSE '' END) AS sources,
    f.country, f.isp, f.usage_type, f.total_reports, f.positives
  FROM local LEFT JOIN v_feed f ON f.indicator = local.indicator)"""


def verdict(x: str) -> str:
    return f"CASE WHEN {x} >= 70 THEN 'malicious' WHEN {x} >= 40 THEN 'suspicious' WHEN {x} >= 10 THEN 'potentially_malicious' ELSE 'benign' END"


def priority(x: str) -> str:
    return f"CASE WHEN {x} >= 70 THEN 'critical' WHEN {x} >= 40 THEN 'high' WHEN {x} >= 10 THEN 'medium' ELSE 'low' END"


INTEL = (V_EVENT, INDICATORS, LOCAL, V_FEED, SCORED)
HUNT = (V_THREAT, V_FEED, """judged AS (
  SELECT f.indicator, greatest(CASE WHEN max(t.user_id) % 34 = 0 THEN 90e0 ELSE 0e0 END, f.positives * 1e0 / f.total * 100, f.abuse_confidence) AS score,
    f.positives, f.total_reports
  FROM v_feed f JOIN v_threat t ON t.source_ip = f.indicator
  GROUP BY f.indicator, f.positives, f.total, f.abuse_confidence, f.total_reports)""")
PAGE_URLS = "urls AS (SELECT DISTINCT url FROM pages)"

ORACLE = {
    "ioc_exact_match": with_views(
        "SELECT indicator, indicator_type, category <> '' AS match, category, confidence FROM local", V_EVENT, INDICATORS, LOCAL),
    "ioc_domain_match": with_views("""
        SELECT page_id, url AS indicator, 'domain' AS indicator_type, m AS match, CASE WHEN m THEN 'suspicious_domain' ELSE '' END AS category,
          CASE WHEN m THEN 0.8e0 ELSE 0e0 END AS confidence
        FROM (SELECT page_id, url, EXISTS (SELECT 1 FROM hosts WHERE contains(lower(url), h)) AS m FROM pages)""", HOSTS),
    "ioc_domain_match_long_list": with_views("""
        SELECT page_id, url AS indicator, d AS domain FROM pages JOIN (
          SELECT DISTINCT regexp_extract(url, '^\\w+://([^/]+)', 1) AS d FROM pages WHERE page_id % 10 = 0) ON contains(lower(url), lower(d))""", HOSTS),
    "ioc_partial_match": with_views(r"""
        , asked AS (SELECT page_id, regexp_extract(url, '^\w+://([^/]+)', 1) AS indicator FROM pages),
        listed AS (SELECT id, value FROM v_ioc WHERE is_active
          UNION ALL SELECT user_id + 1000000, upper(md5(ip)) FROM (SELECT DISTINCT ip, user_id FROM v_event) WHERE user_id % 5 = 0
          UNION ALL SELECT page_id + 2000000, regexp_extract(url, '^\w+://([^/]+)', 1) FROM pages WHERE page_id % 10 = 0)
        SELECT page_id, indicator, min(id) IS NOT NULL AS match, coalesce(min(id), -1) AS ioc_id, coalesce(min_by(value, id), '') AS ioc_value
        FROM asked LEFT JOIN listed ON contains(lower(value), lower(indicator)) GROUP BY page_id, indicator""", V_EVENT, V_IOC),
    "ioc_summary": with_views("""
        , n AS (SELECT 'ip' AS ioc_type, count(*) AS n FROM v_ioc WHERE is_active
          UNION ALL SELECT 'hash', count(DISTINCT ip) FROM v_event WHERE user_id % 5 = 0
          UNION ALL SELECT 'domain', count(*) FROM pages WHERE page_id % 10 = 0)
        SELECT * FROM n UNION ALL SELECT 'total', CAST(sum(n) AS BIGINT) FROM n""", V_EVENT, V_IOC),
    "ioc_maintain": with_views("""
        SELECT 'ip' AS ioc_type, value, is_active AND id % 3 <> 0 AS is_active FROM v_ioc
        UNION ALL SELECT DISTINCT 'ip', ip, true FROM v_event WHERE user_id % 4 = 0 AND user_id % 17 <> 0""", V_EVENT, V_IOC),
    "ioc_reputation": threat(f"""
        , u AS (SELECT DISTINCT user_id AS u FROM v_event), a AS (SELECT u AS user_id FROM u UNION ALL SELECT u + 256000 FROM u),
        ips AS (SELECT (CASE user_id % 4 WHEN 0 THEN '192.168.' WHEN 1 THEN '10.0.' WHEN 2 THEN '172.16.' ELSE '45.33.' END)
           || (user_id // 256) || '.' || (user_id % 256) AS source_ip FROM a),
        c AS (SELECT source_ip, count(*) AS n FROM v_threat GROUP BY source_ip)
        SELECT source_ip, CASE WHEN i.value IS NOT NULL THEN 'malicious' WHEN n > 5 THEN 'suspicious' WHEN n > 0 THEN 'low_risk' ELSE 'clean' END AS reputation,
          CASE WHEN i.value IS NOT NULL THEN 'high' WHEN n > 5 THEN 'medium' WHEN n > 0 THEN 'low' ELSE 'high' END AS confidence,
          coalesce(n, 0) AS threat_count, coalesce({day('i.created_at')}, '') AS first_seen
        FROM ips LEFT JOIN c USING (source_ip) LEFT JOIN (SELECT * FROM v_ioc WHERE is_active) i ON i.value = source_ip""", V_IOC),
    "intel_score": with_views("SELECT indicator, indicator_type, round(loose, 6) AS overall_score, sources FROM scored", *INTEL),
    "intel_verdict": with_views(f"SELECT indicator, {verdict('loose')} AS verdict FROM scored", *INTEL),
    "intel_details": with_views("""
        SELECT indicator, coalesce(country, '') AS countries, coalesce(isp, '') AS isps, coalesce(usage_type, '') AS usage_types,
          category AS categories, coalesce(total_reports, 0) AS reports FROM scored""", *INTEL),
    "intel_batch": with_views(f"""
        SELECT indicator, indicator_type, strict AS overall_score, {verdict('strict')} AS verdict, sources, category, coalesce(total_reports, 0) AS reports
        FROM scored WHERE indicator_type = 'ip'
        UNION ALL SELECT url, 'domain', CASE WHEN m THEN 80e0 ELSE 0e0 END, CASE WHEN m THEN 'malicious' ELSE 'benign' END, 'local',
          CASE WHEN m THEN 'suspicious_domain' ELSE '' END, 0
        FROM (SELECT url, EXISTS (SELECT 1 FROM hosts WHERE contains(lower(url), h)) AS m FROM urls)""", *INTEL, HOSTS, PAGE_URLS),
    "intel_search": with_views(f"""
        SELECT indicator, round(loose, 6) AS overall_score, {verdict('loose')} AS verdict FROM scored
        WHERE indicator_type = 'ip' AND loose BETWEEN 40 AND 95""", *INTEL),
    "threat_hunting": with_views(f"""
        SELECT t.id AS threat_id, source_ip, round(score, 6) AS overall_score, {priority('score')} AS priority, t.risk_score,
          concat_ws('|', CASE WHEN score >= 70 THEN 'Immediate isolation and blocking recommended|Conduct full forensic analysis' END,
            CASE WHEN score >= 40 THEN 'Review all logs for related activity|Check for lateral movement' END,
            CASE WHEN positives > 0 THEN 'Cross-reference with other security tools' END,
            CASE WHEN total_reports > 10 THEN 'Consider IP reputation-based blocking' END) AS recommendations
        FROM v_threat t JOIN judged ON indicator = source_ip
        ORDER BY CASE WHEN score >= 70 THEN 0 WHEN score >= 40 THEN 1 WHEN score >= 10 THEN 2 ELSE 3 END, t.risk_score DESC, t.id LIMIT 20""", *HUNT),
    "threat_hunting_stats": with_views(f"""
        SELECT {priority('score')} AS priority, count(*) AS threats FROM v_threat JOIN judged ON indicator = source_ip GROUP BY 1""", *HUNT),
    "geo_enrich": threat("SELECT id, source_ip, country, city, latitude, longitude, country_code FROM v_threat JOIN v_geo ON ip = source_ip", V_GEO),
    "geo_top_countries": threat("""
        SELECT country, count(*) AS threats, min(country_code) AS country_code FROM v_threat JOIN v_geo ON ip = source_ip
        WHERE country <> 'Unknown' GROUP BY country ORDER BY threats DESC, country LIMIT 10""", V_GEO),
    "geo_top_cities": threat("""
        , j AS (SELECT country, city FROM v_threat JOIN v_geo ON ip = source_ip)
        (SELECT 'city' AS section, city AS name, count(*) AS threats FROM j GROUP BY city ORDER BY threats DESC, city LIMIT 5)
        UNION ALL (SELECT 'country', country, count(*) AS threats FROM j GROUP BY country ORDER BY threats DESC, country LIMIT 5)""", V_GEO),
    "blocklist_build": threat(f"""
        SELECT source_ip AS value, min_by('Auto-blocked: risk score ' || printf('%.1f', risk_score) || ' for ' || threat_type, id) AS description,
          {day('min(ts)')} AS ts, 'auto-block' AS source, true AS is_active
        FROM v_threat WHERE risk_score >= 9 AND user_id % 17 <> 0 GROUP BY source_ip"""),
    "blocklist_apply": with_views("SELECT id, source_ip, user_id % 34 = 0 AS is_blocked FROM v_log", V_LOG),
    "blocklist_apply_drop": with_views("SELECT id FROM v_log WHERE user_id % 34 <> 0", V_LOG),
}

"""Security-log views over the shared test tables (events, lineitem, nation)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.common import evaluate_once, spread
from logwarden.operators.parsing import normalize_log_entry, parse_log_lines

AS_OF_YEAR = "2024-12-31 23:59:59"
CLICK_URLS = ["/search?q=UNION SELECT", "/search?q=<script>", "/../../etc/passwd", "/run;ls", "/wp-admin", "/about"]


# tables whose rows are costly to search, worth dealing out when they come as one small file
LONG_TEXT = ["documents", "pages", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(rows) if name in LONG_TEXT else rows


def with_ip_and_k(events: DataFrame) -> DataFrame:
    """``ip`` from the user id and ``k`` from the properties."""
    user = F.col("user_id")
    prefix = F.element_at(
        F.array(*map(F.lit, ["192.168.", "10.0.", "172.16.", "45.33."])), (user % 4 + 1).cast("int")
    )
    return events.withColumns(
        {
            "k": F.get_json_object("props", "$.k").cast("int"),
            "ip": F.concat(prefix, F.floor(user / 256).cast("string"), F.lit("."), (user % 256).cast("string")),
        }
    )


def raw_lines(events: DataFrame) -> DataFrame:
    """One log line per event: (event_id, ts, raw)."""
    e = with_ip_and_k(events)
    k = F.col("k")
    access_time = F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    syslog_time = F.date_format("ts", "MMM dd HH:mm:ss")
    page = F.format_string(
        '%s - - [%s +0000] "GET /page/%d HTTP/1.1" %d %d',
        "ip", access_time, k, F.when(k % 10 == 0, 404).otherwise(200), k + 200,
    )
    url = F.element_at(F.array(*map(F.lit, CLICK_URLS)), k % 6 + 1)
    click = F.format_string('%s - - [%s +0000] "GET %s HTTP/1.1" 403 %d', "ip", access_time, url, k)
    ssh = "%s server sshd[%d]: %s password for user from %s port %d ssh2"
    failed = F.format_string(ssh, syslog_time, "event_id", F.lit("Failed"), "ip", k + 40000)
    accepted = F.format_string(ssh, syslog_time, "event_id", F.lit("Accepted"), "ip", k + 40000)
    packet = F.format_string(
        "%s firewall kernel: [UFW %s] IN=eth0 OUT= SRC=%s DST=10.0.0.1 LEN=60 PROTO=%s SPT=45678 DPT=%d",
        syslog_time,
        F.when(k % 5 == 0, "ALLOW").otherwise("BLOCK"),
        "ip",
        F.when(k % 3 == 0, "UDP").otherwise("TCP"),
        k + 20,
    )
    kind = F.col("event_type")
    raw = (
        F.when(kind == "view", page).when(kind == "click", click).when(kind == "error", failed)
        .when(kind == "signup", accepted).when(kind == "purchase", packet)
    )
    return evaluate_once(e.select("event_id", "ts", "ip", "k", "event_type"), raw=raw).select("event_id", "ts", "raw")


def v_log_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_lines(spread(table(spark, sf_dir, "events")))


def logs_from_events(events: DataFrame) -> DataFrame:
    lines = raw_lines(events).select(
        F.col("event_id").alias("id"),
        (F.date_trunc("second", "ts") + F.make_interval(hours=(F.col("event_id") % 48).cast("int"))).alias("ingested_at"),
        F.col("raw").alias("raw_log"),
    )
    return normalize_log_entry(parse_log_lines(lines, as_of=AS_OF_YEAR))


def v_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs_from_events(spread(table(spark, sf_dir, "events")))


def threats_from_events(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    threat_type = (
        F.when(kind == "error", "brute_force").when(kind == "purchase", "port_scan")
        .when(kind == "click", "suspicious_pattern").when(kind == "signup", "anomaly").otherwise("ddos")
    )
    ts = F.date_trunc("second", "ts")
    return with_ip_and_k(events).select(
        F.col("event_id").alias("id"),
        threat_type.alias("threat_type"),
        F.col("ip").alias("source_ip"),
        F.least(F.lit(10.0), F.col("value") / 10).alias("risk_score"),
        F.concat(threat_type, F.lit(" seen with code "), F.col("k").cast("string")).alias("description"),
        ts.alias("timestamp"),
        (ts + F.make_interval(hours=(F.col("event_id") % 48).cast("int"))).alias("ingested_at"),
        F.when(F.col("event_id") % 5 == 0, "resolved").otherwise("active").alias("status"),
        F.lit(None).cast("string").alias("ai_explanation"),
    )


def v_threat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threats_from_events(table(spark, sf_dir, "events"))


def v_ioc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One indicator per address whose user id is a multiple of 17."""
    e = with_ip_and_k(table(spark, sf_dir, "events")).where(F.col("user_id") % 17 == 0)
    return e.groupBy("ip", "user_id").agg(F.min("ts").alias("seen")).select(
        F.col("user_id").alias("id"),
        F.lit("ip").alias("ioc_type"),
        F.col("ip").alias("value"),
        F.lit("listed address").alias("description"),
        F.lit("high").alias("threat_level"),
        F.lit("view").alias("source"),
        F.date_trunc("second", "seen").alias("created_at"),
        (F.col("user_id") % 2 == 0).alias("is_active"),
    )


COUNTRIES = ["CN", "RU", "PK", "US", "DE"]


def v_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A place per nation."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        key.alias("nation"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("City "), key.cast("string")).alias("city"),
        (key * 2.0).alias("latitude"),
        (key * 3.0).alias("longitude"),
        F.element_at(F.array(*map(F.lit, COUNTRIES)), key % 5 + 1).alias("country_code"),
    )


def v_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact table: public addresses (user id mod 4 = 3) whose user id is odd in steps of eight."""
    e = with_ip_and_k(table(spark, sf_dir, "events")).where(F.col("user_id") % 8 == 3)
    ips = e.select("ip", (F.col("user_id") % 25).alias("nation")).distinct()
    return ips.join(v_place(spark, sf_dir), "nation").drop("nation")


def v_geo_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CIDR table: one /29 block of 45.33.0.0/24 per nation, and one wide block around them."""
    place = v_place(spark, sf_dir)
    blocks = place.withColumn("cidr", F.concat(F.lit("45.33.0."), (F.col("nation") * 8).cast("string"), F.lit("/29")))
    wide = place.where("nation = 0").withColumn("cidr", F.lit("45.33.0.0/16"))
    return blocks.where("nation % 2 = 0").unionByName(wide).drop("nation")


def v_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = with_ip_and_k(table(spark, sf_dir, "events"))
    return e.groupBy("ip").agg(
        F.count("*").alias("n"),
        F.sum((F.col("k") >= 60).cast("bigint")).alias("positives"),
        F.max("user_id").alias("user"),
    ).select(
        F.col("ip").alias("indicator"),
        "positives",
        F.col("n").alias("total"),
        (F.col("user") % 101).cast("double").alias("abuse_confidence"),
        (F.col("n") % 30).alias("total_reports"),
        F.element_at(F.array(*map(F.lit, COUNTRIES)), (F.col("user") % 5 + 1).cast("int")).alias("country"),
        F.concat(F.lit("isp "), (F.col("user") % 7).cast("string")).alias("isp"),
        F.lit("Data Center").alias("usage_type"),
    )


def v_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status changes: every seventh event changes the threat at half its id, so some change twice."""
    e = with_ip_and_k(table(spark, sf_dir, "events")).where(F.col("event_id") % 7 == 0)
    status = F.element_at(F.array(*map(F.lit, ["resolved", "investigating", "false_positive"])), F.col("k") % 3 + 1)
    return e.select(
        F.col("event_id").alias("change_id"),
        (F.floor(F.col("event_id") / 14) * 14).alias("target_id"),
        status.alias("status"),
        F.date_trunc("second", "ts").alias("changed_at"),
        F.concat(F.lit("analyst "), (F.col("k") % 4).cast("string")).alias("user"),
    )


FLOW_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def v_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow rows: five features, an id, and R as the attack label."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("flow_id"),
        *[F.col(f).cast("double").alias(f) for f in FLOW_FEATURES],
        F.when(F.col("l_returnflag") == "R", "Attack").otherwise("Normal").alias("Attack_Type"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_attack"),
    )


FLOW_LABELS = {"AF": "DoS Hulk", "AO": "PortScan", "NF": "BENIGN", "NO": "BENIGN", "RF": "Web Attack – XSS", "RO": "Strange"}


def v_flow_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = F.concat("l_returnflag", "l_linestatus")
    label = None
    for key, name in FLOW_LABELS.items():
        label = F.when(flags == key, name) if label is None else label.when(flags == key, name)
    return table(spark, sf_dir, "lineitem").select(label.alias("Label"))

"""Streaming jobs, run to the end over the events table, and sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.q_detect import FAILED, SCAN, WEIGHT
from checks.shape import flat, scratch
from checks.sqlviews import V_EVENT, V_IOC, V_LOG, V_THREAT, day, log, round_1, threat, with_views
from logwarden.operators import flows as fl
from logwarden.operators import iforest
from logwarden.operators.parsing import ENTRY_FEATURES, entry_features
from logwarden.plans import views as v
from logwarden.sources import flows as flow_source
from logwarden.sources import logs as log_source
from logwarden.sources import sinks
from logwarden.streaming import jobs as op

DAY = 86400


def events_stream(s, d):
    """The events table as a file stream."""
    schema = v.table(s, d, "events").schema
    return s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


def log_stream(s, d):
    return v.logs_from_events(events_stream(s, d))


def threat_stream(s, d):
    return v.threats_from_events(events_stream(s, d))


def finished(df):
    """Run a stream over what is there and read back what it wrote."""
    s = df.sparkSession
    out, state = scratch(s, "stream"), scratch(s, "state")
    op.start(df, out, state, available_now=True).awaitTermination()
    # no result may have no file at all, so the schema is given
    return s.read.schema(df.schema).parquet(out)


PARTS, LATE_S = 4, 50 * 60


def in_parts(s, d):
    """The events as they arrive: four parts by time, of which a third of the rows comes up to 50 minutes late, in the
    next part; at last two rows from two months later: the first moves the watermark past all others, for the second's batch."""
    e = v.table(s, d, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = e.agg(F.min(micros), F.max(micros)).first()
    arrival = micros + F.when(F.col("event_id") % 3 == 0, LATE_S * 1_000_000).otherwise(0)
    part = F.least(F.lit(PARTS - 1), F.floor((arrival - low) * PARTS / (high - low + 1)))
    for number in range(PARTS):
        yield e.where(part == number)
    last = e.orderBy(F.desc("event_id")).limit(1).withColumn("ts", F.col("ts") + F.expr("INTERVAL 60 DAYS"))
    for number in (-1, -2):
        yield last.select([F.lit(number).cast(t).alias(c) if c == "event_id" else F.col(c).cast(t).alias(c) for c, t in e.dtypes])


def by_parts(s, d, build, run):
    """Let ``run`` work on ``build(stream of events)`` each time that a further part has arrived."""
    folder = scratch(s, "events")
    schema = v.table(s, d, "events").schema
    for rows in in_parts(s, d):
        rows.write.mode("append").parquet(folder)
        stream = build(s.readStream.schema(schema).parquet(folder))
        run(stream).awaitTermination()
    return stream


def arriving(s, d, build):
    """What a stream has written after all parts; it is stopped and started again for each."""
    out, state = scratch(s, "stream"), scratch(s, "state")
    stream = by_parts(s, d, build, lambda df: op.start(df, out, state, available_now=True))
    return s.read.schema(stream.schema).parquet(out)


def logs_arriving(s, d, job):
    return arriving(s, d, lambda events: job(v.logs_from_events(events)))


def threats_arriving(s, d, job):
    return arriving(s, d, lambda events: job(v.threats_from_events(events)))


def late_rows(s, d):
    """Rows more than ten minutes behind what came before them."""
    out, state = scratch(s, "late"), scratch(s, "state")
    build = lambda events: events.select("event_id", F.col("ts").cast("timestamp").alias("timestamp"))
    stream = by_parts(s, d, build, lambda df: op.stream_late_rows(df, out, state, "10 minutes", available_now=True))
    return s.read.schema(stream.schema).parquet(f"{out}/late")


def lines_written(s, d):
    """The raw lines as log files."""
    path = scratch(s, "lines")
    v.v_log_raw(s, d).select("raw").write.text(path, lineSep="\n")
    return path


def read_back(s, path):
    return s.read.text(path, pathGlobFilter="*.txt")


def forest_and_scale(s, d):
    entries = entry_features(v.v_log(s, d)).select("id", *ENTRY_FEATURES)
    scale = fl.fit_standardize(entries, ENTRY_FEATURES)
    return iforest.fit(fl.flow_standardize(entries, scale), ENTRY_FEATURES, trees=100, id_column="id"), scale


def anomaly_stream(s, d):
    forest, scale = forest_and_scale(s, d)
    scored = op.stream_anomaly_score(log_stream(s, d), forest, scale)
    return finished(scored.select("id", "source_ip", "anomaly_score", "is_anomaly"))


def sink_stream(s, d):
    out, state = scratch(s, "soc"), scratch(s, "state")
    op.stream_sink_threats(threat_stream(s, d), out, state, available_now=True).awaitTermination()
    threats, alerts, incidents = (s.read.parquet(f"{out}/{t}") for t in ("threat", "alert", "incident"))
    per_threat = threats.join(alerts.select(F.col("threat_id").alias("id"), F.lit(True).alias("a")), "id", "left").join(
        incidents.select(F.col("threat_ids")[0].alias("id"), F.lit(True).alias("i")), "id", "left")
    return per_threat.select("id", "risk_score", "risk_level", F.coalesce("a", F.lit(False)).alias("alert"), F.coalesce("i", F.lit(False)).alias("incident"))


def log_source_stream(s, d):
    lines = op.stream_log_source(s, lines_written(s, d), pattern="*.txt")
    return finished(lines.select("raw_log"))


def csv_back(s, d):
    path = scratch(s, "csv")
    sinks.sink_threat_csv(v.v_threat(s, d), path)
    return s.read.csv(path, header=True)


def export_back(s, d, kind, part="search_history"):
    path = scratch(s, kind)
    history = v.v_log(s, d).select(F.col("source_ip").alias("indicator"), "timestamp", F.col("id").alias("score"))
    sinks.sink_intel_export(history, v.v_ioc(s, d), path, format=kind)
    reader = s.read.option("header", True).option("rowTag", part).format(kind)
    return reader.load(f"{path}/{part}")


def tables_back(s, d):
    path = scratch(s, "tables")
    sinks.sink_soc_tables(path, threat=v.v_threat(s, d), log_entry=v.v_log(s, d))
    counts = [
        s.read.parquet(f"{path}/{t}").groupBy("event_date").agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), F.date_format("event_date", "yyyy-MM-dd").alias("event_date"), "n")
        for t in ("threat", "log_entry")
    ]
    return counts[0].unionByName(counts[1])


FLOW_COLUMNS = [" Flow Duration", "Total Fwd Packets ", " Flow Bytes/s", " Flow Packets/s", " Label"]


def flow_csv(s, d):
    """The flow view as CSV with padded names, infinite rates and missing values."""
    path = scratch(s, "flows")
    rows = v.table(s, d, "lineitem").select(
        F.col("l_extendedprice").alias(FLOW_COLUMNS[0]), F.col("l_quantity").alias(FLOW_COLUMNS[1]),
        F.when(F.col("l_linenumber") == 1, "Infinity").otherwise(F.col("l_tax").cast("string")).alias(FLOW_COLUMNS[2]),
        F.when(F.col("l_linenumber") == 2, "NaN").when(F.col("l_linenumber") == 3, None).otherwise(F.col("l_discount").cast("string")).alias(FLOW_COLUMNS[3]),
        F.when(F.col("l_returnflag") == "R", "DDoS").otherwise("BENIGN").alias(FLOW_COLUMNS[4]),
    )
    rows.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return flow_source.read_flows(s, path)


def feed_rows(s, d):
    """A feed that lists every address with user id divisible by 3, once per event."""
    e = v.with_ip_and_k(v.table(s, d, "events")).where("user_id % 3 = 0")
    return e.select(F.col("ip").alias("value"), F.lit("ip").alias("type"), F.lit("scanning").alias("threat_type"))


QUERIES = {
    "src_log_text": lambda s, d: flat(log_source.read_logs(s, lines_written(s, d), pattern="*.txt"), "raw_log AS raw"),
    "src_log_text_line_numbers": lambda s, d: flat(
        log_source.read_logs(s, lines_written(s, d), pattern="*.txt", line_numbers=True).groupBy("file_path")
        .agg(F.count("*").alias("n"), F.sum("line_number").alias("total"), F.max("line_number").alias("last"))
        .agg(F.sum("n").alias("n"), F.bool_and(F.expr("last = n AND total = n * (n + 1) / 2")).alias("consecutive"))),
    "src_flow_csv": lambda s, d: flat(
        flow_csv(s, d), "`Flow Duration` AS duration", "`Total Fwd Packets` AS packets", "`Flow Bytes/s` AS bytes", "`Flow Packets/s` AS rate",
        "Label", "Attack_Type", "is_attack"),
    "src_threat_feed": lambda s, d: flat(log_source.src_threat_feed(feed_rows(s, d), v.v_ioc(s, d)), "ioc_type", "value", "threat_type", "source"),
    "sink_threat_csv": lambda s, d: flat(csv_back(s, d), "ID AS id", "`Threat Type` AS threat_type", "`Source IP` AS source_ip", "Timestamp AS ts", "Status AS status"),
    "sink_intel_export": lambda s, d: flat(export_back(s, d, "json"), "indicator", "CAST(score AS BIGINT) AS score"),
    "sink_intel_export_csv": lambda s, d: flat(export_back(s, d, "csv"), "indicator", "CAST(score AS BIGINT) AS score"),
    "sink_intel_export_xml": lambda s, d: flat(export_back(s, d, "xml"), "indicator", "CAST(score AS BIGINT) AS score"),
    "sink_intel_export_database": lambda s, d: flat(export_back(s, d, "json", "ioc_database"), "ioc_type", "value", "id", "is_active"),
    "sink_intel_export_totals": lambda s, d: flat(
        export_back(s, d, "xml", "system_info"), "total_searches", "total_iocs", "export_timestamp IS NOT NULL AS dated"),
    "sink_soc_tables": lambda s, d: flat(tables_back(s, d)),
    "stream_log_source": lambda s, d: flat(log_source_stream(s, d), "raw_log AS raw"),
    "stream_parse": lambda s, d: flat(
        finished(op.stream_parse(
            v.raw_lines(events_stream(s, d)).select(F.col("event_id").alias("id"), F.col("raw").alias("raw_log")), as_of=v.AS_OF_YEAR)),
        "id", "timestamp AS ts", "source_ip", "parsed_data.log_type", "action"),
    "stream_dedup": lambda s, d: flat(
        finished(op.stream_dedup(log_stream(s, d).unionByName(log_stream(s, d).where("id % 4 = 0")), watermark="40 days")), "source_ip", "raw_log AS raw"),
    "stream_brute_force": lambda s, d: flat(
        logs_arriving(s, d, lambda logs: op.stream_brute_force(logs, "1 hour", window_s=DAY, slide_s=DAY // 2, threshold=2)),
        "source_ip", "window_start", "attempt_count", "risk_score"),
    "stream_port_scan": lambda s, d: flat(
        logs_arriving(s, d, lambda logs: op.stream_port_scan(logs, "1 hour", window_s=10 * DAY, slide_s=5 * DAY, min_attempts=4, min_ports=3)),
        "source_ip", "window_start", "total_attempts", "unique_ports", "risk_score"),
    "stream_suspicious_pattern": lambda s, d: flat(
        logs_arriving(s, d, lambda logs: op.stream_suspicious_pattern(logs, "1 hour", window_s=3 * DAY, cooldown_s=DAY)),
        "source_ip", "timestamp AS ts", "total_matches", "risk_score"),
    "stream_ddos_minute": lambda s, d: flat(
        threats_arriving(s, d, lambda threats: op.stream_ddos_minute(threats, "1 hour", threshold=2)), "minute", "event_count", "confidence_score"),
    "stream_threat_dedup": lambda s, d: flat(
        threats_arriving(s, d, lambda threats: op.stream_threat_dedup(threats, "1 hour", gap_s=2 * DAY)), "id", "source_ip", "threat_type"),
    "stream_state_ttl": lambda s, d: flat(
        threats_arriving(s, d, lambda threats: op.stream_state_ttl(threats).groupBy(F.window("timestamp", "1 day").alias("w"), "threat_type")
                         .agg(F.count("*").alias("n")).select("w.start", "threat_type", "n")), "start", "threat_type", "n"),
    "stream_anomaly_score": lambda s, d: flat(anomaly_stream(s, d)),
    "stream_rate_metric": lambda s, d: flat(
        logs_arriving(s, d, lambda logs: op.stream_rate_metric(logs, "1 hour")), "minute", "n", "logs_per_second"),
    "stream_late_rows": lambda s, d: flat(late_rows(s, d), "event_id", "timestamp AS ts"),
    "stream_sink_threats": lambda s, d: flat(sink_stream(s, d)),
}

WINDOWS = "w AS (SELECT TIMESTAMP '2023-12-20' + INTERVAL 1 SECOND * {slide} * i AS start FROM range(0, 200) r(i))"
HITS = "hits AS (SELECT source_ip, ts, unnest(tags) AS tag FROM v_log)"
TIME = "((CASE WHEN hour(ts) >= 22 OR hour(ts) <= 6 THEN 1.5e0 ELSE 0e0 END) + (CASE WHEN isodow(ts) >= 6 THEN 1e0 ELSE 0e0 END))"
MULT = "(CASE threat_type WHEN 'brute_force' THEN 1.2e0 WHEN 'suspicious_pattern' THEN 1.5e0 WHEN 'anomaly' THEN 1.3e0 WHEN 'ddos' THEN 2.5e0 ELSE 1e0 END)"

ORACLE = {
    "src_log_text": log("SELECT raw FROM v_log"),
    "src_log_text_line_numbers": "SELECT count(*) AS n, true AS consecutive FROM events",
    "src_flow_csv": """
        SELECT l_extendedprice AS duration, l_quantity AS packets, l_tax AS bytes, l_discount AS rate, CASE WHEN l_returnflag = 'R' THEN 'DDoS' ELSE 'BENIGN' END AS Label,
          CASE WHEN l_returnflag = 'R' THEN 'DDoS Attack' ELSE 'Normal' END AS Attack_Type, CAST(l_returnflag = 'R' AS BIGINT) AS is_attack
        FROM lineitem WHERE l_linenumber > 3""",
    "src_threat_feed": with_views("""
        SELECT DISTINCT 'ip' AS ioc_type, ip AS value, 'scanning' AS threat_type, 'imported_misp' AS source FROM v_event
        WHERE user_id % 3 = 0 AND user_id % 17 <> 0""", V_EVENT),
    "sink_threat_csv": threat("SELECT CAST(id AS VARCHAR) AS id, threat_type, source_ip, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS ts, status FROM v_threat"),
    **{
        f"sink_intel_export{suffix}": log("SELECT source_ip AS indicator, id AS score FROM v_log ORDER BY ts DESC, source_ip LIMIT 50")
        for suffix in ("", "_csv", "_xml")
    },
    "sink_intel_export_database": with_views("SELECT ioc_type, value, id, is_active FROM v_ioc", V_EVENT, V_IOC),
    "sink_intel_export_totals": with_views(
        "SELECT (SELECT count(*) FROM events) AS total_searches, (SELECT count(*) FROM v_ioc) AS total_iocs, true AS dated", V_EVENT, V_IOC),
    "sink_soc_tables": with_views("""
        SELECT name, strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS n FROM v_event, (VALUES ('threat'), ('log_entry')) t(name) GROUP BY ALL""", V_EVENT),
    "stream_log_source": log("SELECT raw FROM v_log"),
    "stream_parse": log(f"SELECT id, {day('ts')} AS ts, source_ip, log_type, action FROM v_log"),
    "stream_dedup": log("SELECT source_ip, raw FROM v_log"),
    "stream_brute_force": log(f""", {WINDOWS.format(slide=DAY // 2)}
        SELECT source_ip, {day('start')} AS window_start, count(*) AS attempt_count, least(count(*) * 2e0, 10e0) AS risk_score
        FROM v_log JOIN w ON ts >= start AND ts < start + INTERVAL 1 DAY WHERE {FAILED} GROUP BY source_ip, start HAVING count(*) >= 2"""),
    "stream_port_scan": log(f""", w AS (SELECT TIMESTAMP '1970-01-01' + INTERVAL 5 DAY * i AS start FROM range(3900, 4000) r(i))
        SELECT source_ip, {day('start')} AS window_start, count(*) AS total_attempts, count(DISTINCT port) AS unique_ports,
          least(round(count(*) * 0.3e0 + count(DISTINCT port) * 0.5e0, 1), 10e0) AS risk_score
        FROM v_log JOIN w ON ts >= start AND ts < start + INTERVAL 10 DAY WHERE {SCAN} GROUP BY source_ip, start
        HAVING count(*) >= 4 AND count(DISTINCT port) >= 3"""),
    "stream_ddos_minute": threat(f"""
        SELECT {day("date_trunc('minute', ts)")} AS minute, count(*) AS event_count, round(least(count(*) / 200e0, 0.95e0), 6) AS confidence_score
        FROM v_threat WHERE threat_type = 'ddos' GROUP BY 1 HAVING count(*) >= 2"""),
    "stream_threat_dedup": "WITH RECURSIVE " + V_THREAT + """,
        chain AS (
          SELECT source_ip, threat_type, min(ts) AS ts FROM v_threat GROUP BY source_ip, threat_type
          UNION ALL
          SELECT c.source_ip, c.threat_type, min(t.ts) FROM chain c JOIN v_threat t
            ON t.source_ip = c.source_ip AND t.threat_type = c.threat_type AND t.ts > c.ts + INTERVAL 2 DAY
          GROUP BY c.source_ip, c.threat_type, c.ts)
        SELECT min(id) AS id, source_ip, threat_type FROM chain JOIN v_threat USING (source_ip, threat_type, ts)
        GROUP BY source_ip, threat_type, ts""",
    "stream_suspicious_pattern": "WITH RECURSIVE " + V_LOG + f""",
        {HITS},
        tot AS (SELECT source_ip, ts, count(*) OVER w AS n, sum({WEIGHT}) OVER w AS weighted FROM hits
          WINDOW w AS (PARTITION BY source_ip ORDER BY ts RANGE BETWEEN INTERVAL 3 DAY PRECEDING AND CURRENT ROW)),
        q AS (SELECT DISTINCT source_ip, ts, n, weighted FROM tot WHERE n >= 3),
        chain AS (
          SELECT source_ip, min(ts) AS ts FROM q GROUP BY source_ip
          UNION ALL
          SELECT c.source_ip, min(q.ts) FROM chain c JOIN q ON q.source_ip = c.source_ip AND q.ts >= c.ts + INTERVAL 1 DAY GROUP BY c.source_ip, c.ts)
        SELECT source_ip, {day('ts')} AS ts, n AS total_matches, least(round(weighted, 1), 10e0) AS risk_score FROM chain JOIN q USING (source_ip, ts)""",
    "stream_state_ttl": threat(f"SELECT {day("date_trunc('day', ts)")} AS start, threat_type, count(*) AS n FROM v_threat GROUP BY date_trunc('day', ts), threat_type"),
    "stream_rate_metric": log(f"""
        SELECT {day("date_trunc('minute', ts)")} AS minute, count(*) AS n, round(count(*) / 60e0, 2) AS logs_per_second FROM v_log GROUP BY 1"""),
    "stream_late_rows": """
        WITH s AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events),
        p AS (SELECT event_id, ts, least(3, (epoch_us(ts) + CASE WHEN event_id % 3 = 0 THEN 3000000000 ELSE 0 END - low) * 4 // (high - low + 1)) AS part FROM events, s),
        m AS (SELECT part, max(ts) AS newest FROM p GROUP BY part),
        w AS (SELECT part + 1 AS part, max(newest) OVER (ORDER BY part) - INTERVAL 10 MINUTE AS mark FROM m)
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM p JOIN w USING (part) WHERE ts < mark""",
    "stream_sink_threats": threat(f"""
        , s AS (SELECT id, least((risk_score * 0.6e0 + {TIME} * 0.1e0) * {MULT}, 10e0) AS u, threat_type FROM v_threat),
        r AS (SELECT id, threat_type, u, {round_1('u')} AS risk_score FROM s)
        SELECT id, risk_score, l AS risk_level, l IN ('CRITICAL', 'HIGH') OR risk_score >= 7 OR (threat_type IN ('brute_force', 'suspicious_pattern') AND risk_score >= 5) AS alert,
          risk_score >= 5 AS incident
        FROM (SELECT *, CASE WHEN u >= 8 THEN 'CRITICAL' WHEN u >= 6 THEN 'HIGH' WHEN u >= 4 THEN 'MEDIUM' WHEN u >= 2 THEN 'LOW' ELSE 'INFO' END AS l FROM r)"""),
}

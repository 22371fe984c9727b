"""Whole jobs: from log lines to threats, alerts, incidents and patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import with_stable_id, with_threat_id
from logwarden.operators import alerts, correlate, detect, risk, search
from logwarden.operators.parsing import normalize_log_entry, parse_log_lines
from logwarden.sources.logs import read_logs
from logwarden.sources.sinks import sink_soc_tables


def brute_force_report(
    logs: DataFrame, window_s: int = rules.BRUTE_FORCE_WINDOW_S, threshold: int = rules.BRUTE_FORCE_THRESHOLD
) -> DataFrame:
    """Addresses that reached the threshold at any time, with their overall risk, worst first."""
    threats = detect.detect_brute_force_sliding(logs, window_s, threshold)
    return (
        risk.risk_comprehensive(threats)
        .select("source_ip", "risk_score", "risk_level", F.col("details.attempt_count").alias("attempts"), "timestamp")
        .orderBy(F.desc("risk_score"), F.desc("attempts"), "source_ip")
    )


def detected(logs: DataFrame, anomalies: bool = True, **settings: dict) -> DataFrame:
    """Threats of all detectors with stable ids; ``settings`` has arguments by detector's name."""
    found = [
        detect.detect_brute_force(logs, **settings.get("brute_force", {})),
        detect.detect_port_scan(logs, **settings.get("port_scan", {})),
        detect.detect_suspicious_pattern(logs, **settings.get("suspicious_pattern", {})),
    ]
    if anomalies:
        found.append(detect.detect_anomalies(logs, **settings.get("anomaly", {})))
    return with_threat_id(detect.threat_union(*found))


def soc_batch(
    logs: DataFrame, path: str, mode: str = "append", thresholds: dict | None = None, hours: int | None = 24, anomalies: bool = True, **settings: dict,
) -> dict[str, DataFrame]:
    """The whole batch job: entries without repeats, scored threats, alerts, incidents and patterns, written under ``path``.

    Threats are detected and scored once: what follows from them reads the written table, so a lost executor repeats its
    own tasks only, and all tables name the same threats.  A job that runs again over the same logs gives the same ids.
    Returns the tables as read back; ``thresholds`` and ``hours`` are those of the patterns.
    """
    spark = logs.sparkSession

    def written(name: str, rows: DataFrame) -> DataFrame:
        sink_soc_tables(path, mode, **{name: rows})
        return spark.read.schema(rows.schema).parquet(f"{path}/{name}")

    entries = written("log_entry", search.log_dedup_exact(with_stable_id(logs, ["source_ip", "timestamp", "raw_log"])))
    threats = written("threat", risk.risk_comprehensive(detected(entries, anomalies, **settings)))
    message = alerts.alert_candidates(threats).select(
        F.col("id").alias("threat_id"), F.lit("message").alias("alert_type"), "description", F.lit(None).cast("string").alias("sent"),
        F.col("timestamp").alias("created_at"))
    return {
        "log_entry": entries,
        "threat": threats,
        "alert": written("alert", message),
        "incident": written("incident", correlate.incident_create(threats)),
        "attack_pattern": written("attack_pattern", correlate.pattern_union_recent(threats, hours=hours, thresholds=thresholds)),
    }


def soc_batch_files(spark: SparkSession, folder: str, path: str, pattern: str = "*.log", as_of=None, **options) -> dict[str, DataFrame]:
    """:func:`soc_batch` over a folder of log files."""
    return soc_batch(normalize_log_entry(parse_log_lines(read_logs(spark, folder, pattern=pattern), as_of=as_of)), path, **options)

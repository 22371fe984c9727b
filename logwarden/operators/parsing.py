"""Raw lines to structured log entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import evaluate_once, ladder, operator
from logwarden.functions import net, parsing


@operator
def parse_log_lines(df: DataFrame, as_of=None, verdict: bool = True) -> DataFrame:
    """First matching format wins; a line without any dotted quad is dropped.

    Adds log_type, the captured fields, timestamp, suspicious_patterns and is_private_ip to the
    columns of ``df``, which needs ``raw_log``.  ``as_of`` gives year-less times their year and
    stands in for unreadable ones (default: now).
    """
    now = F.current_timestamp() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp"))
    raw = F.col("raw_log")
    kept = df.withColumn("raw_log", strip(raw)).where(raw.rlike(rules.DOTTED_QUAD))
    kind, parts = F.col("log_type"), F.col("_parts")
    split = kept.withColumn("log_type", parsing.log_type(raw)).withColumn("_parts", parsing.capture(raw, kind))
    action = parsing.group(parts, "action")
    once = evaluate_once(
        split.withColumn("_time", parsing.group(parts, "timestamp")),
        log_type=kind,
        _parts=parts,
        timestamp=parsing.event_time(F.col("_time"), now),
        action=verdict_or(action) if verdict else action,
    )
    fields = {f: parsing.group(parts, f) for f in parsing.FIELDS if f not in ("timestamp", "action")}
    parsed = once.withColumns(fields).drop("_parts", "_time")
    return net.with_private_flag(parsing.with_tags(parsed, "raw_log"), "ip")


def verdict_or(action: Column) -> Column:
    return F.when(F.col("log_type") == "firewall", parsing.firewall_verdict(F.col("raw_log"))).otherwise(action)


def strip(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"))


@operator
def parse_timestamps(df: DataFrame, text: str = "time_text", as_of=None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumn("timestamp", parsing.event_time(F.col(text), now))


@operator
def tag_suspicious_patterns(df: DataFrame, text: str = "raw_log", tags=rules.SUSPICIOUS_TAGS) -> DataFrame:
    return parsing.with_tags(df, text, tags)


@operator
def classify_private_ip(df: DataFrame, ip: str = "source_ip") -> DataFrame:
    return net.with_private_flag(df, ip)


@operator
def extract_first_ip(df: DataFrame, text: str = "raw_log") -> DataFrame:
    return df.withColumn("first_ip", net.first_ip(F.col(text)))


@operator
def firewall_verdict(df: DataFrame) -> DataFrame:
    """Action of firewall lines from their verdict word; other lines keep theirs."""
    return df.withColumn("action", verdict_or(F.col("action")))


@operator
def normalize_log_entry(df: DataFrame, keep: tuple[str, ...] = ("id", "ingested_at")) -> DataFrame:
    """Parsed lines in the stored shape; columns named in ``keep`` pass through if present."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in df.columns else F.lit("")

    line_number = F.col("line_number").cast("bigint") if "line_number" in df.columns else F.lit(None).cast("bigint")
    return df.select(
        *[c for c in keep if c in df.columns],
        "timestamp",
        text("ip").alias("source_ip"),
        F.col("port").cast("int").alias("destination_port"),
        text("protocol").alias("protocol"),
        text("action").alias("action"),
        "raw_log",
        F.struct(
            "log_type",
            text("method").alias("method"),
            text("url").alias("url"),
            text("status").alias("status"),
            text("size").alias("size"),
            "suspicious_patterns",
            "is_private_ip",
            text("file_path").alias("file_path"),
            line_number.alias("line_number"),
        ).alias("parsed_data"),
    )


def failed_attempt() -> Column:
    return parsing.is_failed_attempt(F.col("action"), F.col("raw_log"), F.col("parsed_data.status"))


def port_scan_attempt() -> Column:
    return parsing.is_port_scan_attempt(F.col("destination_port"), F.col("protocol"), F.col("action"))


@operator
def flag_failed_attempt(logs: DataFrame) -> DataFrame:
    return logs.withColumn("is_failed_attempt", failed_attempt())


@operator
def flag_port_scan_attempt(logs: DataFrame) -> DataFrame:
    return logs.withColumn("is_port_scan_attempt", port_scan_attempt())


@operator
def indicator_type(df: DataFrame, value: str = "indicator") -> DataFrame:
    return df.withColumn("indicator_type", net.indicator_type(F.col(value)))


@operator
def risk_level_bands(df: DataFrame, score: str = "risk_score", scale: str = "risk", bands=None) -> DataFrame:
    """Level of a score on one of the four scales, or on ``bands`` of the caller."""
    return df.withColumn("risk_level", ladder(F.col(score), bands or rules.BANDS[scale]))


ENTRY_FEATURES = ["f_hour", "f_minute", "f_weekday", "f_port", "f_tcp", "f_udp", "f_icmp", "f_denied", "f_tags"]


@operator
def entry_features(logs: DataFrame) -> DataFrame:
    """Nine numbers per log entry, as doubles."""
    ts, protocol, action = F.col("timestamp"), F.lower("protocol"), F.lower("action")
    values = [
        F.hour(ts),
        F.minute(ts),
        F.weekday(ts),
        F.coalesce(F.col("destination_port"), F.lit(0)),
        F.coalesce(protocol == "tcp", F.lit(False)),
        F.coalesce(protocol == "udp", F.lit(False)),
        F.coalesce(protocol == "icmp", F.lit(False)),
        F.coalesce(action.isin("drop", "reject"), F.lit(False)),
        F.coalesce(F.size("parsed_data.suspicious_patterns"), F.lit(0)),
    ]
    return logs.withColumns({n: v.cast("int").cast("double") for n, v in zip(ENTRY_FEATURES, values)})

"""Detectors: log entries to threats.

The plain forms look at one trailing window that ends at ``as_of`` and, as published, has no upper
bound.  The ``_sliding`` forms apply the same rule to every trailing window of the history and
report each address's worst one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import as_of_col, before, epoch, first_per_key, lookup, operator, round_1
from logwarden.functions import scoring
from logwarden.functions.parsing import name_list
from logwarden.operators import iforest
from logwarden.operators.flows import fit_standardize, flow_standardize
from logwarden.operators.parsing import ENTRY_FEATURES, entry_features, failed_attempt, port_scan_attempt
from logwarden.operators.sweep import in_blocks, step

# One details struct for all detectors, so that their outputs can be stored and united.
# Times of attempts are kept as (second, count) pairs: log times have whole seconds, so nothing is
# lost, and the list is bounded by the window instead of by the number of attempts.
DETAIL_FIELDS = {
    "attempt_count": "bigint",
    "time_window": "bigint",
    "attempts": "array<struct<at:timestamp,n:bigint>>",
    "total_attempts": "bigint",
    "unique_ports": "bigint",
    "ports_scanned": "array<int>",
    "total_matches": "bigint",
    "pattern_breakdown": "map<string,bigint>",
    "recent_matches": "array<timestamp>",
    "anomaly_count": "bigint",
    "average_anomaly_score": "double",
    "recent_anomalies": "array<timestamp>",
}


def details(**given: Column) -> Column:
    fields = [given.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in DETAIL_FIELDS.items()]
    return F.struct(*fields).alias("details")


def threat_rows(df: DataFrame, kind: str, score: Column, description: Column, detail: Column) -> DataFrame:
    return df.select(
        F.lit(kind).alias("threat_type"),
        "source_ip",
        score.alias("risk_score"),
        description.alias("description"),
        F.col("timestamp"),
        detail,
    )


def seconds_to_ts(sec: Column) -> Column:
    return F.timestamp_seconds(sec)


def brute_force_text(n: Column, window_s: int) -> Column:
    return F.format_string(f"Brute force attack detected: %d failed attempts in {window_s} seconds", n)


def port_scan_text(n: Column, ports: Column) -> Column:
    return F.format_string("Port scan detected: %d connection attempts to %d different ports", n, ports)


@operator
def detect_brute_force(
    logs: DataFrame, as_of=None, window_s: int = rules.BRUTE_FORCE_WINDOW_S, threshold: int = rules.BRUTE_FORCE_THRESHOLD
) -> DataFrame:
    """At least ``threshold`` failed attempts of one address since ``as_of - window_s``."""
    start = before(as_of_col(logs, as_of), window_s)
    per_second = (
        logs.where(failed_attempt() & (F.col("timestamp") >= start))
        .groupBy("source_ip", epoch("timestamp").alias("sec"))
        .agg(F.count("*").alias("n"))
    )
    per_ip = (
        per_second.groupBy("source_ip")
        .agg(
            F.sum("n").alias("n"),
            F.max("sec").alias("last"),
            F.sort_array(F.collect_list(F.struct(F.timestamp_seconds("sec").alias("at"), "n"))).alias("attempts"),
        )
        .where(F.col("n") >= threshold)
        .withColumn("timestamp", F.timestamp_seconds("last"))
    )
    n = F.col("n")
    return threat_rows(
        per_ip, "brute_force", scoring.brute_force_score(n), brute_force_text(n, window_s),
        details(attempt_count=n, time_window=F.lit(window_s), attempts=F.col("attempts")),
    )


@operator
def detect_brute_force_sliding(
    logs: DataFrame, window_s: int = rules.BRUTE_FORCE_WINDOW_S, threshold: int = rules.BRUTE_FORCE_THRESHOLD
) -> DataFrame:
    """Each address's highest number of failures in any trailing window, where it reaches the threshold.

    ``timestamp`` is the end of the earliest such window.
    """
    per_second = (
        logs.where(failed_attempt())
        .groupBy("source_ip", epoch("timestamp").alias("at"))
        .agg(F.count("*").alias("n"))
    )
    placed, block_s = in_blocks(per_second, "at", window_s)
    start, end = F.col("_block") * block_s, F.col("at") + window_s + 1
    enters, leaves = F.greatest(F.col("at"), start), F.least(end, start + block_s)
    changes = placed.select(
        "source_ip",
        "_block",
        F.inline(
            F.array(
                step(enters, n=F.col("n"), own=F.col("_own").cast("bigint")),
                step(leaves, n=-F.col("n"), own=F.lit(0)),
            )
        ),
    )
    per_change = changes.groupBy("source_ip", "_block", "sec").agg(F.sum("n").alias("n"), F.max("own").alias("own"))
    running = Window.partitionBy("source_ip", "_block").orderBy("sec")
    peaks = (
        per_change.withColumn("n", F.sum("n").over(running))
        .where((F.col("own") == 1) & (F.col("n") >= threshold))
        .groupBy("source_ip")
        .agg(F.max(F.struct("n", (-F.col("sec")).alias("neg"))).alias("peak"))
        .select("source_ip", F.col("peak.n").alias("n"), F.timestamp_seconds(-F.col("peak.neg")).alias("timestamp"))
    )
    n = F.col("n")
    return threat_rows(
        peaks, "brute_force", scoring.brute_force_score(n), brute_force_text(n, window_s),
        details(attempt_count=n, time_window=F.lit(window_s)),
    )


@operator
def detect_port_scan(
    logs: DataFrame,
    as_of=None,
    window_s: int = rules.PORT_SCAN_WINDOW_S,
    min_attempts: int = rules.PORT_SCAN_MIN_ATTEMPTS,
    min_ports: int = rules.PORT_SCAN_MIN_PORTS,
) -> DataFrame:
    """Many denied attempts of one address on many ports since ``as_of - window_s``."""
    start = before(as_of_col(logs, as_of), window_s)
    per_port = (
        logs.where(port_scan_attempt() & (F.col("destination_port") != 0) & (F.col("timestamp") >= start))
        .groupBy("source_ip", "destination_port")
        .agg(F.count("*").alias("n"), F.max("timestamp").alias("last"))
    )
    per_ip = (
        per_port.groupBy("source_ip")
        .agg(
            F.sum("n").alias("n"),
            F.count("*").alias("ports"),
            F.max("last").alias("timestamp"),
            F.sort_array(F.collect_list("destination_port")).alias("ports_scanned"),
        )
        .where((F.col("n") >= min_attempts) & (F.col("ports") >= min_ports))
    )
    n, ports = F.col("n"), F.col("ports")
    return threat_rows(
        per_ip, "port_scan", scoring.port_scan_score(n, ports), port_scan_text(n, ports),
        details(total_attempts=n, unique_ports=ports, time_window=F.lit(window_s), ports_scanned=F.col("ports_scanned")),
    )


@operator
def detect_port_scan_sliding(
    logs: DataFrame,
    window_s: int = rules.PORT_SCAN_WINDOW_S,
    min_attempts: int = rules.PORT_SCAN_MIN_ATTEMPTS,
    min_ports: int = rules.PORT_SCAN_MIN_PORTS,
) -> DataFrame:
    """Each address's trailing window with the highest score among those that reach both minima.

    A port counts in a window from an attempt on it until that attempt leaves the window or the
    next attempt on the same port takes over, so the number of different ports is a running total
    too.
    """
    per_second = (
        logs.where(port_scan_attempt() & (F.col("destination_port") != 0))
        .groupBy("source_ip", "destination_port", epoch("timestamp").alias("at"))
        .agg(F.count("*").alias("n"))
    )
    placed, block_s = in_blocks(per_second, "at", window_s)
    per_port = Window.partitionBy("source_ip", "_block", "destination_port").orderBy("at")
    start = F.col("_block") * block_s
    limit = start + block_s
    enters = F.greatest(F.col("at"), start)
    leaves = F.least(F.col("at") + window_s + 1, limit)
    hands_over = F.greatest(enters, F.least(F.coalesce(F.col("next"), leaves), leaves))
    zero, one = F.lit(0), F.lit(1)
    changes = placed.withColumn("next", F.lead("at").over(per_port)).select(
        "source_ip",
        "_block",
        F.inline(
            F.array(
                step(enters, n=F.col("n"), ports=one, own=F.col("_own").cast("bigint")),
                step(leaves, n=-F.col("n"), ports=zero, own=zero),
                step(hands_over, n=zero, ports=-one, own=zero),
            )
        ),
    )
    per_change = changes.groupBy("source_ip", "_block", "sec").agg(
        F.sum("n").alias("n"), F.sum("ports").alias("ports"), F.max("own").alias("own")
    )
    running = Window.partitionBy("source_ip", "_block").orderBy("sec")
    worst = (
        per_change.withColumns({"n": F.sum("n").over(running), "ports": F.sum("ports").over(running)})
        .where((F.col("own") == 1) & (F.col("n") >= min_attempts) & (F.col("ports") >= min_ports))
        .withColumn("weight", F.col("n") * 3 + F.col("ports") * 5)
        .groupBy("source_ip")
        .agg(F.max(F.struct("weight", "n", "ports", (-F.col("sec")).alias("neg"))).alias("w"))
        .select("source_ip", "w.n", "w.ports", F.timestamp_seconds(-F.col("w.neg")).alias("timestamp"))
    )
    n, ports = F.col("n"), F.col("ports")
    return threat_rows(
        worst, "port_scan", scoring.port_scan_score(n, ports), port_scan_text(n, ports),
        details(total_attempts=n, unique_ports=ports, time_window=F.lit(window_s)),
    )


@operator
def detect_suspicious_pattern(
    logs: DataFrame,
    as_of=None,
    window_s: int = rules.PATTERN_WINDOW_S,
    min_matches: int = rules.PATTERN_MIN_MATCHES,
    weights=None,
) -> DataFrame:
    """At least ``min_matches`` tags of one address since ``as_of - window_s``, scored by tag weight."""
    start = before(as_of_col(logs, as_of), window_s)
    hits = logs.where((F.col("timestamp") >= start) & (F.col("source_ip") != "")).select(
        "source_ip", "timestamp", F.explode("parsed_data.suspicious_patterns").alias("tag")
    )
    weight = lookup(F.col("tag"), weights or rules.TAG_WEIGHTS, rules.OTHER_TAG_WEIGHT)
    per_ip = (
        hits.groupBy("source_ip", "tag")
        .agg(F.count("*").alias("n"), F.max("timestamp").alias("last"))
        .groupBy("source_ip")
        .agg(
            F.sum("n").alias("total"),
            F.sum(F.col("n") * weight).alias("weighted"),
            F.max("last").alias("timestamp"),
            F.sort_array(F.collect_list(F.struct("tag", "n"))).alias("breakdown"),
        )
        .where(F.col("total") >= min_matches)
    )
    recent = (
        first_per_key(hits, ["source_ip"], [F.desc("timestamp"), F.asc("tag")], 5)
        .groupBy("source_ip")
        .agg(F.sort_array(F.collect_list("timestamp")).alias("recent"))
    )
    joined = per_ip.join(recent, "source_ip")
    listed = F.array_join(
        F.transform("breakdown", lambda b: F.concat(F.lit("'"), b["tag"], F.lit("': "), b["n"].cast("string"))), ", "
    )
    return threat_rows(
        joined, "suspicious_pattern",
        round_1(F.least(F.col("weighted"), F.lit(10.0))),
        F.concat(F.lit("Suspicious patterns detected: {"), listed, F.lit("}")),
        details(
            total_matches=F.col("total"), time_window=F.lit(window_s),
            pattern_breakdown=F.map_from_entries("breakdown"), recent_matches=F.col("recent"),
        ),
    )


@operator
def detect_anomalies(
    logs: DataFrame,
    last_n: int | None = None,
    min_rows: int = rules.ANOMALY_MIN_ROWS,
    min_per_ip: int = rules.ANOMALY_MIN_PER_IP,
    contamination: float = rules.ANOMALY_CONTAMINATION,
    forest: iforest.IsolationForest | None = None,
    scale: dict | None = None,
    seed: int = 42,
) -> DataFrame:
    """Addresses with several entries that an isolation forest sets apart.

    Looks at the latest ``last_n`` entries (None: at all; the published job takes ``rules.ANOMALY_LAST_N``).  Fits scaling and forest on them unless
    both are given; with fewer than ``min_rows`` entries there is no threat.
    """
    chosen = logs if last_n is None else logs.orderBy(F.desc("timestamp"), F.desc("id")).limit(last_n)
    entries = entry_features(chosen).select("id", "source_ip", "timestamp", *ENTRY_FEATURES)
    scale = scale or fit_standardize(entries, ENTRY_FEATURES)
    scaled = flow_standardize(entries, scale)
    forest = forest or iforest.fit(scaled, ENTRY_FEATURES, contamination=contamination, seed=seed, id_column="id")
    flagged = iforest.predict(scaled, forest).where("is_anomaly")
    # distance to the cut, negative for anomalies as published
    margin = F.lit(forest.cut) - F.col("anomaly_score")
    per_ip = flagged.groupBy("source_ip").agg(
        F.count("*").alias("n"), F.avg(margin).alias("mean"), F.max("timestamp").alias("timestamp"))
    recent = (
        first_per_key(flagged, ["source_ip"], [F.desc("timestamp"), F.desc("id")], 3)
        .groupBy("source_ip").agg(F.sort_array(F.collect_list("timestamp")).alias("recent"))
    )
    enough = chosen.limit(min_rows).agg(F.count("*") >= min_rows).scalar()
    found = per_ip.where((F.col("n") >= min_per_ip) & enough).join(recent, "source_ip")
    n, mean = F.col("n"), F.col("mean")
    return threat_rows(
        found, "anomaly", scoring.anomaly_score(mean, n),
        F.format_string("Anomalous behavior detected: %d anomalous events", n),
        details(anomaly_count=n, average_anomaly_score=mean, recent_anomalies=F.col("recent")),
    )


@operator
def threat_union(*threats: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), threats)


@operator
def threat_dedup_15m(threats: DataFrame, store: DataFrame, gap_s: int = rules.THREAT_DEDUP_S) -> DataFrame:
    """Drop threats whose (ip, type) has a stored one in the ``gap_s`` before them.

    The store is reduced to first and last time per slot of ``gap_s``; a threat then needs only the
    first time of its own slot and the last time of the slot before, so the join has one row per
    key and slot on the store's side.
    """
    keys = ["source_ip", "threat_type", "_slot"]
    sec = epoch("timestamp")
    slots = store.groupBy("source_ip", "threat_type", F.floor(sec / gap_s).alias("_slot")).agg(
        F.min(sec).alias("first"), F.max(sec).alias("last")
    )
    none = F.lit(None).cast("bigint")
    seen = (
        slots.select(
            "source_ip",
            "threat_type",
            F.inline(
                F.array(
                    F.struct(F.col("_slot"), F.col("first").alias("own_first"), none.alias("prev_last")),
                    F.struct((F.col("_slot") + 1).alias("_slot"), none.alias("own_first"), F.col("last").alias("prev_last")),
                )
            ),
        )
        .groupBy(*keys)
        .agg(F.max("own_first").alias("own_first"), F.max("prev_last").alias("prev_last"))
    )
    duplicate = (F.col("own_first") <= F.col("_sec")) | (F.col("prev_last") >= F.col("_sec") - gap_s)
    return (
        threats.withColumns({"_sec": sec, "_slot": F.floor(sec / gap_s)})
        .join(seen, keys, "left")
        .where(~F.coalesce(duplicate, F.lit(False)))
        .drop("_sec", "_slot", "own_first", "prev_last")
    )


@operator
def threat_dedup_chain(threats: DataFrame, gap_s: int = rules.THREAT_DEDUP_S, order: str = "id") -> DataFrame:
    """Within one batch, keep a threat of an (ip, type) and silence those up to ``gap_s`` after it.

    What is kept depends on what was kept before, so the times of a key are followed in order.  They
    are reduced to one row per second first and streamed through in sorted batches: no group is ever
    held as a whole.
    """
    keys = ["source_ip", "threat_type"]
    seconds = threats.groupBy(*keys, epoch("timestamp").alias("sec")).agg(F.min(order).alias(order))

    def follow(batches):
        key, last = None, 0
        for pdf in batches:
            keep = []
            for ip, kind, sec in zip(pdf["source_ip"], pdf["threat_type"], pdf["sec"]):
                kept = key != (ip, kind) or sec - last > gap_s
                if kept:
                    key, last = (ip, kind), sec
                keep.append(kept)
            yield pdf[keep]

    kept = seconds.repartition(*keys).sortWithinPartitions(*keys, "sec").mapInPandas(follow, seconds.schema)
    return threats.join(kept.select(*keys, order), [*keys, order], "left_semi")


def evidence_types(scan_verdicts=("drop", "DROP")) -> Column:
    """Threat types a log entry can be evidence for."""
    brute = F.col("action").isin("failed", "FAILED") | F.lower("raw_log").contains("failed")
    scan = F.col("destination_port").isNotNull() & (F.col("destination_port") != 0) & F.col("action").isin(*scan_verdicts)
    tagged = F.size("parsed_data.suspicious_patterns") > 0
    return name_list(
        F.when(brute, "brute_force"), F.when(scan, "port_scan"), F.when(tagged, "suspicious_pattern"), F.lit("anomaly")
    )


@operator
def threat_log_link(threats: DataFrame, logs: DataFrame, per_threat: int = 5) -> DataFrame:
    """Up to ``per_threat`` log entries of each threat's address that fit its type, lowest id first.

    The entries depend on (address, type) only, so they are picked once per pair and then joined:
    work grows with logs + threats, not with their product.
    """
    keys = ["source_ip", "threat_type"]
    fitting = logs.select("source_ip", F.col("id").alias("log_id"), F.explode(evidence_types()).alias("threat_type"))
    evidence = first_per_key(fitting, keys, [F.asc("log_id")], per_threat)
    return threats.select(F.col("id").alias("threat_id"), *keys).join(evidence, keys)


@operator
def detector_retention(df: DataFrame, as_of=None, keep_s: int = rules.DETECTOR_RETENTION_S) -> DataFrame:
    return df.where(F.col("timestamp") >= before(as_of_col(df, as_of), keep_s))

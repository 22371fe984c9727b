"""Threats to patterns, classes, sequences and incidents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import as_of_col, before, first_per_key, operator, text_list, title_case

PATTERN_COLUMNS = [
    "pattern_type", "pattern_key", "source_ips", "target_ports", "start_time", "end_time", "event_count",
    "confidence_score", "description",
]


def _recent(threats: DataFrame, as_of, hours: int | None) -> DataFrame:
    if hours is None:
        return threats
    return threats.where(F.col("timestamp") >= before(as_of_col(threats, as_of), hours * 3600))


def _type_has(words: list[str]) -> Column:
    low = F.lower("threat_type")
    hit = F.lit(False)
    for word in words:
        hit = hit | low.contains(word)
    return hit


def _capped(confidence: Column) -> Column:
    return F.least(confidence, F.lit(rules.PATTERN_MAX_CONFIDENCE))


def _pattern_per_ip(threats: DataFrame, name: str, as_of, hours, threshold) -> DataFrame:
    rule = rules.PATTERN_RULES[name]
    n = F.col("event_count")
    confidence = n / rule["divide_by"] if "divide_by" in rule else n * F.lit(rule["times"])
    before_ip, rest = rule["text"].split("{ip}")
    middle, after = rest.split("{n}")
    ports = F.array(*map(F.lit, rule["ports"])) if rule["ports"] else F.array().cast("array<int>")
    return (
        _recent(threats, as_of, hours)
        .where(_type_has(rule["words"]))
        .groupBy("source_ip")
        .agg(F.count("*").alias("event_count"), F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"))
        .where(n >= (rule["threshold"] if threshold is None else threshold))
        .select(
            F.lit(name).alias("pattern_type"),
            F.col("source_ip").alias("pattern_key"),
            F.array("source_ip").alias("source_ips"),
            ports.alias("target_ports"),
            "start_time",
            "end_time",
            "event_count",
            _capped(confidence).alias("confidence_score"),
            F.concat(F.lit(before_ip), "source_ip", F.lit(middle), n.cast("string"), F.lit(after)).alias("description"),
        )
    )


@operator
def pattern_brute_force(threats: DataFrame, as_of=None, hours: int | None = 24, threshold: int | None = None) -> DataFrame:
    """Addresses with at least ``threshold`` brute-force or login threats.

    The ids behind a pattern are rows of :func:`pattern_members`, not an array: an address may hold
    any number of them.
    """
    return _pattern_per_ip(threats, "brute_force", as_of, hours, threshold)


@operator
def pattern_port_scan(threats: DataFrame, as_of=None, hours: int | None = 24, threshold: int | None = None) -> DataFrame:
    return _pattern_per_ip(threats, "port_scan", as_of, hours, threshold)


@operator
def pattern_suspicious(threats: DataFrame, as_of=None, hours: int | None = 24, threshold: int | None = None) -> DataFrame:
    return _pattern_per_ip(threats, "suspicious_activity", as_of, hours, threshold)


@operator
def pattern_anomalous(threats: DataFrame, as_of=None, hours: int | None = 24, threshold: int | None = None) -> DataFrame:
    return _pattern_per_ip(threats, "anomalous_behavior", as_of, hours, threshold)


def _minute_key(minute: Column) -> Column:
    return F.date_format(minute, "yyyy-MM-dd HH:mm")


@operator
def pattern_ddos(
    threats: DataFrame, as_of=None, hours: int | None = 24, threshold: int | None = None, max_ips: int = 10
) -> DataFrame:
    """Minutes with at least ``threshold`` flood threats, with the first ``max_ips`` addresses.

    Counts go over (minute, address) first, so a minute that holds most rows is reduced before its
    rows meet.
    """
    minute = F.date_trunc("minute", "timestamp")
    per_ip = (
        _recent(threats, as_of, hours)
        .where(_type_has(rules.DDOS_WORDS))
        .groupBy(minute.alias("minute"), "source_ip")
        .agg(F.count("*").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
    )
    busy = (
        per_ip.groupBy("minute")
        .agg(F.sum("n").alias("event_count"), F.count("*").alias("ips"), F.min("first").alias("start_time"), F.max("last").alias("end_time"))
        .where(F.col("event_count") >= (rules.DDOS_PER_MINUTE if threshold is None else threshold))
    )
    named = (
        first_per_key(per_ip, ["minute"], [F.asc("source_ip")], max_ips)
        .groupBy("minute")
        .agg(F.sort_array(F.collect_list("source_ip")).alias("source_ips"))
    )
    n = F.col("event_count")
    return busy.join(named, "minute").select(
        F.lit("ddos").alias("pattern_type"),
        _minute_key(F.col("minute")).alias("pattern_key"),
        "source_ips",
        F.array(*map(F.lit, rules.DDOS_PORTS)).alias("target_ports"),
        "start_time",
        "end_time",
        "event_count",
        _capped(n / 200).alias("confidence_score"),
        F.format_string("DDoS attack detected with %d requests from %d sources", n, "ips").alias("description"),
    )


@operator
def pattern_union_recent(threats: DataFrame, as_of=None, hours: int | None = 24, thresholds: dict | None = None) -> DataFrame:
    t = thresholds or {}
    parts = [
        pattern_brute_force(threats, as_of, hours, t.get("brute_force")),
        pattern_ddos(threats, as_of, hours, t.get("ddos")),
        pattern_port_scan(threats, as_of, hours, t.get("port_scan")),
        pattern_suspicious(threats, as_of, hours, t.get("suspicious_activity")),
        pattern_anomalous(threats, as_of, hours, t.get("anomalous_behavior")),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@operator
def pattern_members(
    threats: DataFrame, patterns: DataFrame, as_of=None, hours: int | None = 24, max_ddos: int | None = None
) -> DataFrame:
    """(pattern_type, pattern_key, threat_id) for every threat behind ``patterns``.

    ``max_ddos`` keeps the first ids of a flood minute only; the published value is 50."""
    recent = _recent(threats, as_of, hours).select("id", "source_ip", "threat_type", "timestamp")
    kinds = F.array_compact(
        F.array(*[
            F.when(_type_has(rule["words"]), F.struct(F.lit(name).alias("pattern_type"), F.col("source_ip").alias("pattern_key")))
            for name, rule in rules.PATTERN_RULES.items()
        ])
    )
    by_ip = recent.select(F.col("id").alias("threat_id"), F.inline(kinds))
    minute = F.date_trunc("minute", "timestamp")
    floods = recent.where(_type_has(rules.DDOS_WORDS)).select(
        F.col("id").alias("threat_id"), F.lit("ddos").alias("pattern_type"), _minute_key(minute).alias("pattern_key")
    )
    by_minute = floods if max_ddos is None else first_per_key(floods, ["pattern_type", "pattern_key"], [F.asc("threat_id")], max_ddos)
    keys = ["pattern_type", "pattern_key"]
    return by_ip.unionByName(by_minute).join(patterns.select(*keys), keys, "left_semi").select(*keys, "threat_id")


@operator
def pattern_persist_first(patterns: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """The first pattern of each type that has no active stored one."""
    first = first_per_key(patterns, ["pattern_type"], [F.asc("start_time"), F.asc("pattern_key")])
    if stored is not None:
        active = stored.where("status = 'active'").select("pattern_type")
        first = first.join(active, "pattern_type", "left_anti")
    return first.select(*patterns.columns).withColumn("status", F.lit("active"))


# --- classes and sequences ------------------------------------------------------------


def threat_class(description: Column, threat_type: Column, classes=rules.THREAT_CLASSES) -> Column:
    """Best class as a struct (confidence, order, type, severity, match_score).

    A keyword in the description or the type counts 1, an indicator in the description 2; confidence
    is the sum over the number of keywords, times the class's own confidence.
    """
    text, kind = F.lower(F.coalesce(description, F.lit(""))), F.lower(F.coalesce(threat_type, F.lit("")))
    options = []
    for order, (name, keywords, indicators, severity, base) in enumerate(classes):
        score = F.lit(0)
        for word in keywords:
            score = score + (text.contains(word) | kind.contains(word)).cast("int")
        for word in indicators:
            score = score + text.contains(word).cast("int") * 2
        confidence = F.least(score / len(keywords) * F.lit(base), F.lit(rules.MAX_CLASS_CONFIDENCE))
        option = F.struct(
            confidence.alias("confidence"), F.lit(-order).alias("order"), F.lit(name).alias("type"), F.lit(severity).alias("severity"),
            score.cast("bigint").alias("match_score"),
        )
        options.append(F.when(confidence > rules.MIN_CLASS_CONFIDENCE, option))
    default = F.struct(
        F.lit(0.5).alias("confidence"), F.lit(0).alias("order"), F.lit("unknown").alias("type"),
        F.lit("medium").alias("severity"), F.lit(0).cast("bigint").alias("match_score"),
    )
    # the greatest of what is not null: generated code, unlike a filter over an array
    return F.coalesce(F.greatest(*options, F.lit(None)), default)


@operator
def classify_threat_text(threats: DataFrame) -> DataFrame:
    best = threats.withColumn("_class", threat_class(F.col("description"), F.col("threat_type")))
    return best.select(
        *threats.columns,
        F.col("_class.type").alias("class"),
        F.col("_class.confidence").alias("class_confidence"),
        F.col("_class.severity").alias("class_severity"),
        F.col("_class.match_score").alias("match_score"),
    )


def _latest(threats: DataFrame, n: int) -> DataFrame:
    return threats.orderBy(F.desc("timestamp"), F.desc("id")).limit(n)


@operator
def classify_summary(threats: DataFrame, last_n: int | None = None) -> DataFrame:
    """(section, key, n, value): distribution over classes and severities and the mean confidence of
    the latest ``last_n`` threats (None: of all; the published report takes 100)."""
    chosen = threats if last_n is None else _latest(threats, last_n)
    # counted once per (class, severity, confidence); both distributions and the mean follow from it
    counts = classify_threat_text(chosen).groupBy("class", "class_severity", "class_confidence").agg(F.count("*").alias("n"))

    def section(name: str, column: str) -> DataFrame:
        return counts.groupBy(F.col(column).alias("key")).agg(F.sum("n").alias("n")).select(
            F.lit(name).alias("section"), "key", "n", F.lit(None).cast("double").alias("value"))

    total = counts.agg(
        F.lit("total").alias("section"), F.lit("average_confidence").alias("key"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.bround(F.coalesce(F.sum(F.col("class_confidence") * F.col("n")) / F.sum("n"), F.lit(0.0)), 3).alias("value"),
    )
    return section("class", "class").unionByName(section("severity", "class_severity")).unionByName(total)


def _sequences() -> Column:
    return F.array(*[
        F.struct(
            F.lit(i).alias("order"), F.lit(name).alias("sequence_type"), text_list(steps).alias("steps"),
            F.lit(severity).alias("severity"),
        )
        for i, (name, steps, severity) in enumerate(rules.ATTACK_SEQUENCES)
    ])


@operator
def sequence_detect(
    threats: DataFrame, as_of=None, hours: int = 24, by: str | None = None, last_n: int | None = None
) -> DataFrame:
    """Named attack sequences of which at least two steps occur among the recent threats' classes;
    per value of ``by`` (such as source_ip) if given."""
    recent = _recent(threats if last_n is None else _latest(threats, last_n), as_of, hours)
    keys = [by] if by else []
    seen = classify_threat_text(recent).groupBy(*keys).agg(F.collect_set("class").alias("seen"))
    tried = seen.select(*keys, "seen", F.inline(_sequences()))
    matched = tried.withColumn("matched_patterns", F.sort_array(F.array_intersect("steps", "seen")))
    hits = F.size("matched_patterns")
    return (
        matched.where(hits >= 2)
        .withColumn("confidence", hits / F.size("steps"))
        .orderBy(*keys, F.desc("confidence"), "order")
        .select(*keys, "sequence_type", "confidence", "matched_patterns", "severity")
    )


@operator
def predict_next_threat(threats: DataFrame, last_n: int = 50, order: str = "newest") -> DataFrame:
    """Next step of the first sequence with at least two steps among five of the latest threats.

    ``order`` picks the newest five or, as published, the oldest five of the latest ``last_n``.
    No row with fewer than three threats or without a next step.
    """
    latest = _latest(threats, last_n)
    five = latest.orderBy(F.desc("timestamp"), F.desc("id")) if order == "newest" else latest.orderBy("timestamp", "id")
    seen = classify_threat_text(five.limit(5)).agg(F.collect_set("class").alias("seen"), F.count("*").alias("n"))
    tried = seen.where("n >= 3").select("seen", F.inline(_sequences()))
    furthest = F.array_max(
        F.transform("steps", lambda x, i: F.when(F.array_contains("seen", x), i).otherwise(F.lit(-1)))
    )
    open_ = tried.where(F.size(F.array_intersect("steps", "seen")) >= 2).withColumn("at", furthest).where(
        F.col("at") < F.size("steps") - 1
    )
    found = open_.orderBy("order").limit(1).withColumn("predicted_threat", F.get("steps", F.col("at") + 1))
    advice = None
    for name, text in rules.NEXT_THREAT_ADVICE.items():
        hit = F.col("predicted_threat") == name
        advice = F.when(hit, text) if advice is None else advice.when(hit, text)
    return found.select(
        "predicted_threat",
        F.lit(rules.NEXT_THREAT_CONFIDENCE).alias("confidence"),
        F.col("sequence_type").alias("based_on_sequence"),
        advice.otherwise("Monitor system activity closely").alias("recommendation"),
    )


@operator
def incident_create(threats: DataFrame, threshold: float = rules.INCIDENT_THRESHOLD, assigned_to: str | None = None) -> DataFrame:
    """One incident per threat at or above the threshold; its id follows from the threat's."""
    score, high = F.col("risk_score"), F.col("risk_score") >= 7.0
    code = F.upper(F.substring(F.md5(F.col("id").cast("string")), 1, 8))
    return threats.where(score >= threshold).select(
        F.concat_ws("-", F.lit("INC"), F.date_format("timestamp", "yyyyMMdd"), code).alias("incident_id"),
        F.concat(title_case(F.col("threat_type")), F.lit(" from "), "source_ip").alias("title"),
        "description",
        F.when(high, "high").otherwise("medium").alias("severity"),
        F.lit("open").alias("status"),
        F.when(high, 1).otherwise(2).alias("priority"),
        F.lit(assigned_to).cast("string").alias("assigned_to"),
        F.array("id").alias("threat_ids"),
        F.array("source_ip").alias("ioc_ids"),
        F.col("timestamp").alias("created_at"),
        F.col("timestamp").alias("updated_at"),
    )

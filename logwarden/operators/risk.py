"""Risk scoring of threats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import epoch, ladder, operator, round_1, text_list
from logwarden.functions import scoring
from logwarden.operators.enrich import geo_enrich
from logwarden.operators.sweep import running_totals, step

HISTORY = ["recent_threats", "old_threats", "threat_types", "same_type_24h"]


@operator
def risk_history_features(threats: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Earlier threats of the same address, as seen at each threat's own time.

    recent_threats: up to seven whole days back; old_threats: eight to thirty days; threat_types:
    different types in those thirty days; same_type_24h: same type in the last day.  ``history``
    defaults to the threats themselves; where it has a column ``occurrences``, a row counts so often.

    All four are running totals over "enters" and "leaves" records (see ``sweep``), reduced per
    second before any row of a busy address meets another.
    """
    sec = epoch("timestamp")
    source = threats if history is None else history
    n = F.sum("occurrences") if history is not None and "occurrences" in history.columns else F.count("*")
    past = source.groupBy("source_ip", "threat_type", sec.alias("at")).agg(n.alias("n"))
    asked = threats.select("source_ip", "threat_type", sec.alias("sec")).distinct()
    at, n, zero = F.col("at"), F.col("n"), F.lit(0)
    ends = at + rules.HISTORY_LOOKBACK_S + 1
    per_type = Window.partitionBy("source_ip", "threat_type").orderBy("at")
    # a type counts from the second after a threat until it is too old or the next one takes over
    hands_over = F.least(ends, F.coalesce(F.lead("at").over(per_type) + 1, ends))
    address_changes = past.withColumn("_over", hands_over).select(
        "source_ip",
        F.inline(
            F.array(
                step(at + 1, recent=n, old=zero, types=F.lit(1)),
                step(at + rules.HISTORY_RECENT_S, recent=-n, old=n, types=zero),
                step(ends, recent=zero, old=-n, types=zero),
                step(F.col("_over"), recent=zero, old=zero, types=F.lit(-1)),
            )
        ),
    )
    type_changes = past.select(
        "source_ip", "threat_type", F.inline(F.array(step(at + 1, same=n), step(at + 86400 + 1, same=-n)))
    )
    # asking times enter the sweep as changes of nothing, so a total exists at each of them
    ask_address = asked.select("source_ip", "sec").distinct().withColumns(
        {c: zero.cast("bigint") for c in ("recent", "old", "types")}
    )
    ask_type = asked.withColumn("same", zero.cast("bigint"))
    by_address = running_totals(address_changes.unionByName(ask_address), ["source_ip"], "sec", ["recent", "old", "types"])
    by_type = running_totals(type_changes.unionByName(ask_type), ["source_ip", "threat_type"], "sec", ["same"])
    return (
        threats.withColumn("sec", sec)
        .join(by_address, ["source_ip", "sec"], "left")
        .join(by_type, ["source_ip", "threat_type", "sec"], "left")
        .select(
            *[F.col(c) for c in threats.columns],
            F.coalesce("recent", zero).alias("recent_threats"),
            F.coalesce("old", zero).alias("old_threats"),
            F.coalesce("types", zero).alias("threat_types"),
            F.coalesce("same", zero).alias("same_type_24h"),
        )
    )


@operator
def risk_history_score(threats: DataFrame) -> DataFrame:
    """Needs the columns of :func:`risk_history_features`."""
    score = scoring.history_score(F.col("recent_threats"), F.col("old_threats"), F.col("threat_types"))
    return threats.withColumn("threat_history", score)


@operator
def risk_frequency_score(threats: DataFrame) -> DataFrame:
    return threats.withColumn("frequency", scoring.frequency_score(F.col("same_type_24h")))


@operator
def risk_time_score(threats: DataFrame) -> DataFrame:
    return threats.withColumn("time_pattern", scoring.time_score(F.col("timestamp")))


@operator
def risk_geo_score(threats: DataFrame, geo: DataFrame | None = None, ranges: DataFrame | None = None) -> DataFrame:
    """Country risk from a location table; 0 without one."""
    if geo is None and ranges is None:
        return threats.withColumn("geo_location", F.lit(0.0))
    placed = geo_enrich(threats.select(*threats.columns), geo, ranges)
    return placed.select(*threats.columns, scoring.geo_score(F.col("country_code")).alias("geo_location"))


@operator
def risk_severity_multiplier(threats: DataFrame) -> DataFrame:
    return threats.withColumn("severity_multiplier", scoring.severity_multiplier(F.col("threat_type")))


@operator
def risk_comprehensive(
    threats: DataFrame,
    history: DataFrame | None = None,
    geo: DataFrame | None = None,
    ranges: DataFrame | None = None,
    weights=rules.RISK_WEIGHTS,
) -> DataFrame:
    """Final score (one decimal), level (from the unrounded score) and the factors behind them.

    ``history`` None means no known history.  The incoming score is kept as base_threat_score.
    """
    if history is None:
        known = threats.withColumns({c: F.lit(0).cast("bigint") for c in HISTORY})
    else:
        known = risk_history_features(threats, history)
    scored = risk_severity_multiplier(
        risk_geo_score(risk_time_score(risk_frequency_score(risk_history_score(known))), geo, ranges)
    )
    base = F.coalesce(F.col("risk_score"), F.lit(5.0))
    final = scoring.weighted_score(
        base, F.col("threat_history"), F.col("geo_location"), F.col("time_pattern"), F.col("frequency"),
        F.col("severity_multiplier"), weights,
    )
    factors = F.struct(
        base.alias("base_threat_score"), "threat_history", "geo_location", "time_pattern", "frequency", "severity_multiplier"
    )
    rest = [c for c in threats.columns if c != "risk_score"]
    return scored.withColumn("unrounded_score", final).select(
        *rest,
        round_1(F.col("unrounded_score")).alias("risk_score"),
        "unrounded_score",
        scoring.band(F.col("unrounded_score")).alias("risk_level"),
        factors.alias("risk_factors"),
    )


@operator
def risk_recommendations(threats: DataFrame, texts=rules.RECOMMENDATIONS, critical=rules.CRITICAL_RECOMMENDATIONS) -> DataFrame:
    column = None
    for kind, lines in texts.items():
        hit = F.col("threat_type") == kind
        column = F.when(hit, text_list(lines)) if column is None else column.when(hit, text_list(lines))
    more = F.when(F.col("risk_score") >= 8.0, text_list(critical)).otherwise(text_list([]))
    return threats.withColumn("recommendations", F.concat(column.otherwise(text_list([])), more))


@operator
def risk_ml_bump(threats: DataFrame, flag: str = "is_attack") -> DataFrame:
    score = F.col("risk_score")
    bumped = F.when(F.col(flag).cast("boolean") & (score < 8.0), F.least(score + 0.5, F.lit(10.0))).otherwise(score)
    return threats.withColumn("risk_score", bumped)


def _rule_column(kind: Column, pick, default: Column) -> Column:
    column = None
    for name, rule in rules.XAI_RULES.items():
        value = pick(rule)
        column = F.when(kind == name, value) if column is None else column.when(kind == name, value)
    return column.otherwise(default)


@operator
def xai_breakdown(threats: DataFrame, geo: DataFrame | None = None, ranges: DataFrame | None = None) -> DataFrame:
    """Rule, indicators, technique and actions per threat, back-computed score factors, and how
    often the address occurs.  Counts are taken per address and joined back, not over a window that
    would bring all rows of one address together."""
    kind = F.coalesce("threat_type", F.lit("unknown"))
    score = F.coalesce("risk_score", F.lit(5.0))
    rule, indicators, actions = rules.XAI_DEFAULT
    technique = None
    for name, code, title, _ in rules.MITRE_TECHNIQUES:
        text = F.lit(f"{code} — {title}")
        technique = F.when(kind == name, text) if technique is None else technique.when(kind == name, text)
    technique = technique.otherwise(F.lit("T???? — Unknown Technique"))
    counts = threats.groupBy("source_ip").agg(F.count("*").alias("ip_total_incidents"))
    placed = geo_enrich(threats, geo, ranges).join(counts, "source_ip", "left")
    factors = {
        "base_threat_severity": round_1(F.least(score / 1.2, F.lit(10.0))),
        **{
            f"{name}_risk": round_1(F.least(score * share, F.lit(cap)))
            for name, (share, cap) in rules.XAI_FACTORS.items()
        },
    }
    return placed.select(
        *threats.columns,
        ladder(score, rules.BANDS["explain"]).alias("risk_level"),
        _rule_column(kind, lambda r: F.lit(r[0]), F.lit(rule)).alias("why_flagged"),
        _rule_column(kind, lambda r: text_list(r[1]), text_list(indicators)).alias("indicators"),
        _rule_column(kind, lambda r: text_list(r[2]), text_list(actions)).alias("actions"),
        _rule_column(kind, lambda r: F.lit(r[3]), technique).alias("mitre"),
        F.struct(*[c.alias(n) for n, c in factors.items()]).alias("score_breakdown"),
        "ip_total_incidents",
        (F.col("ip_total_incidents") > 1).alias("ip_is_repeat"),
        "country",
        "city",
    )

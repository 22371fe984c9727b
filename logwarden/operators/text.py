"""Text columns: alert bodies, explanations and message intents."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import evaluate_once, lookup, operator, title_case


def _score_text(score: Column) -> Column:
    return score.cast("string")


@operator
def alert_message_text(threats: DataFrame) -> DataFrame:
    """Adds ``message``: the alert body.  Uses risk_level, details and recommendations if present."""
    has = set(threats.columns)
    level = F.coalesce("risk_level", F.lit("UNKNOWN")) if "risk_level" in has else F.lit("UNKNOWN")
    icon = lookup(level, rules.LEVEL_ICONS, "⚠️")
    head = F.concat(
        icon, F.lit(" SECURITY ALERT "), icon, F.lit("\n\nThreat Type: "), title_case(F.coalesce("threat_type", F.lit("unknown"))),
        F.lit("\nSource IP: "), F.coalesce("source_ip", F.lit("unknown")),
        F.lit("\nRisk Score: "), _score_text(F.coalesce("risk_score", F.lit(0.0))), F.lit("/10.0 ("), level, F.lit(")"),
        F.lit("\nTime: "), F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"),
        F.lit("\n\nDescription:\n"), F.coalesce("description", F.lit("No description available")), F.lit("\n\n"),
    )
    body = [head]
    if "details" in has:
        def line(text: str, field: str, value: Column | None = None) -> Column:
            column = F.col(f"details.{field}")
            shown = column.cast("string") if value is None else value
            return F.when(column.isNotNull(), F.concat(F.lit(f"• {text}: "), shown, F.lit("\n"))).otherwise(F.lit(""))

        body.append(
            F.when(
                F.col("details").isNotNull(),
                F.concat(
                    F.lit("\nAdditional Details:\n"),
                    line("Failed attempts", "attempt_count"),
                    line("Unique ports scanned", "unique_ports"),
                    line("Suspicious patterns", "pattern_breakdown", F.array_join(F.map_keys("details.pattern_breakdown"), ", ")),
                    line("Total pattern matches", "total_matches"),
                ),
            ).otherwise(F.lit(""))
        )
    if "recommendations" in has:
        numbered = F.transform(
            F.slice("recommendations", 1, 3), lambda r, i: F.concat((i + 1).cast("string"), F.lit(". "), r, F.lit("\n"))
        )
        body.append(
            F.when(F.size("recommendations") > 0, F.concat(F.lit("\nRecommendations:\n"), F.array_join(numbered, ""))).otherwise(F.lit(""))
        )
    threat_id = F.coalesce(F.col("id").cast("string"), F.lit("N/A")) if "id" in has else F.lit("N/A")
    body += [F.lit("\nThreat ID: "), threat_id]
    return threats.withColumn("message", F.concat(*body))


def _fill(template: str, values: dict[str, Column]) -> Column:
    """Template text with ``{name}`` places as a concat."""
    parts = []
    for piece in re.split(r"(\{\w+\})", template):
        if piece:
            parts.append(values[piece[1:-1]] if re.fullmatch(r"\{\w+\}", piece) else F.lit(piece))
    return F.concat(*parts)


@operator
def explanation_text(threats: DataFrame, templates=None, default: str = rules.EXPLANATION_DEFAULT) -> DataFrame:
    """Adds ``explanation`` from the template of the threat's type."""
    level = F.coalesce("risk_level", F.lit("UNKNOWN")) if "risk_level" in threats.columns else F.lit("UNKNOWN")
    values = {
        "level": level,
        "ip": F.coalesce("source_ip", F.lit("unknown")),
        "score": _score_text(F.coalesce("risk_score", F.lit(0.0))),
        "type": F.coalesce("threat_type", F.lit("unknown")),
    }
    column = None
    for kind, template in (templates or rules.EXPLANATION_TEXTS).items():
        hit, text = F.col("threat_type") == kind, _fill(template, values)
        column = F.when(hit, text) if column is None else column.when(hit, text)
    return threats.withColumn("explanation", column.otherwise(_fill(default, values)))


def whole_word(word: str) -> bool:
    """Words of up to four characters match as whole words, longer ones and phrases anywhere."""
    return len(word) <= 4 and " " not in word


def intent_pattern(words: list[str]) -> str:
    """The same test as one regex."""
    return "|".join(rf"\b{re.escape(w)}\b" if whole_word(w) else re.escape(w) for w in words)


@operator
def message_intent_tag(messages: DataFrame, text: str = "text", intents=rules.INTENTS) -> DataFrame:
    """Adds ``intent``: the first rule that matches the message.

    Long texts make the regexes dear, so a plain substring search comes before each word test.
    """
    low = F.col("_low")
    column = None
    for name, words in intents:
        hit = F.lit(False)
        for word in words:
            found = low.contains(word)
            hit = hit | (found & low.rlike(rf"\b{re.escape(word)}\b") if whole_word(word) else found)
        column = F.when(hit, name) if column is None else column.when(hit, name)
    return (
        evaluate_once(messages, _low=F.lower(F.trim(text)))
        .withColumn("intent", column.otherwise(rules.OTHER_INTENT))
        .drop("_low")
    )


@operator
def message_intent_counts(messages: DataFrame, text: str = "text", intents=rules.INTENTS) -> DataFrame:
    return message_intent_tag(messages, text, intents).groupBy("intent").agg(F.count("*").alias("n"))

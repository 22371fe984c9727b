"""Line parsing as column expressions: no Python code runs per row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.functions.net import first_ip

SEP = "\x1f"
FIELDS = ["ip", "timestamp", "method", "url", "status", "size", "protocol", "port", "action", "message"]


def log_type(raw: Column, formats=rules.LINE_FORMATS) -> Column:
    """Name of the first format that matches, ``unknown`` with a dotted quad only, else null.

    The cheap test for a text every match contains spares most lines most regexes.
    """
    column = None
    for name, pattern, _, needed in formats:
        hit = raw.contains(needed) & raw.rlike(pattern)
        column = F.when(hit, name) if column is None else column.when(hit, name)
    return column.when(raw.rlike(rules.DOTTED_QUAD), "unknown")


def capture(raw: Column, kind: Column, formats=rules.LINE_FORMATS) -> Column:
    """Captured groups in the order of ``FIELDS``, empty where the format has no such group.

    Each line is rewritten to its groups by a single replace and split once, so a line costs one
    more regex run after the type test, however many groups the format has.
    """
    clean = F.translate(raw, SEP, " ")
    column = None
    for name, pattern, groups, _ in formats:
        layout = SEP.join(f"${groups.index(f) + 1}" if f in groups else "" for f in FIELDS)
        parts = F.split(F.regexp_replace(clean, f"(?s)^.*?(?-s:{pattern}).*$", layout), SEP)
        column = F.when(kind == name, parts) if column is None else column.when(kind == name, parts)
    return column.otherwise(F.array(first_ip(raw)))


def group(parts: Column, field: str) -> Column:
    """One captured field, null where the format has none."""
    return F.nullif(F.get(parts, F.lit(FIELDS.index(field))), F.lit(""))


def name_list(*names: Column) -> Column:
    """Array of the names that are not null, in order.

    Joined and split instead of ``array_compact``, whose lambda would have everything below it
    evaluated without code generation.
    """
    return F.array_remove(F.split(F.concat_ws(SEP, *names), SEP), "")


def event_time(text: Column, as_of: Column) -> Column:
    """Four formats in order; year-less times get the year of ``as_of``, or the one before it if
    that would lie in the future; anything else becomes ``as_of``."""
    spaced = F.regexp_replace(text, r"\s+", " ")
    year = F.year(as_of)

    def in_year(y: Column) -> Column:
        return F.try_to_timestamp(F.concat_ws(" ", y.cast("string"), spaced), F.lit("yyyy MMM d H:m:s"))

    this_year = in_year(year)
    # the shape decides which format can fit at all; a failed parse costs far more than this test
    known = (
        F.when(text.contains("/"), F.try_to_timestamp(spaced, F.lit("d/MMM/yyyy:H:m:s Z")))
        .when(
            text.rlike(r"^[A-Za-z]"),
            F.when(this_year <= as_of, this_year).otherwise(F.coalesce(in_year(year - 1), this_year)),
        )
        .when(text.contains("T"), F.try_to_timestamp(text, F.lit("yyyy-M-d'T'H:m:s")))
        .otherwise(F.try_to_timestamp(spaced, F.lit("yyyy-M-d H:m:s")))
    )
    return F.coalesce(known, as_of)


LITERAL = r"(?:\\[^A-Za-z0-9]|[^\\.^$*+?()\[\]{}|])+"


def literal_words(pattern: str) -> tuple[list[str], bool] | None:
    """Words of a pattern that is only a choice of literals, and whether case matters; else None."""
    whole = re.fullmatch(rf"(\(\?i\))?\(({LITERAL}(?:\|{LITERAL})*)\)", pattern)
    if whole is None:
        return None
    words = [re.sub(r"\\(.)", r"\1", w) for w in re.findall(LITERAL, whole[2])]
    return words, whole[1] is None


def has_tag(raw: Column, low: Column, pattern: str) -> Column:
    """Whether the pattern occurs; a choice of literals is searched as substrings, several times
    faster than as a regex.

    The words are an array under ``exists`` rather than a chain of ORs: written out, the generated
    method of the whole parse outgrows what the JVM compiles, and every line pays for it.
    """
    literal = literal_words(pattern)
    if literal is None:
        return raw.rlike(pattern)
    words, case_matters = literal
    text = raw if case_matters else low
    return F.exists(F.array(*[F.lit(w if case_matters else w.lower()) for w in words]), lambda w: text.contains(w))


def with_tags(df: DataFrame, text: str, tags=rules.SUSPICIOUS_TAGS) -> DataFrame:
    """Adds suspicious_patterns: the names of the matching tag patterns, in rule order.  The
    lower-case text is a column of its own, so it is made once per row and not once per word."""
    raw, low = F.col(text), F.col("_low")
    names = name_list(*[F.when(has_tag(raw, low, p), name) for name, p in tags])
    return df.withColumn("_low", F.lower(raw)).withColumn("suspicious_patterns", names).drop("_low")


def firewall_verdict(raw: Column, verdicts=rules.FIREWALL_VERDICTS) -> Column:
    column = None
    for pattern, action in verdicts:
        hit = raw.rlike(pattern)
        column = F.when(hit, action) if column is None else column.when(hit, action)
    return column


def is_failed_attempt(action: Column, raw: Column, status: Column) -> Column:
    low = F.lower(raw)
    return (
        F.coalesce(F.lower(action).isin("drop", "reject", "failed"), F.lit(False))
        | F.coalesce(low.contains("failed"), F.lit(False))
        | F.coalesce(status.startswith("4") | status.startswith("5"), F.lit(False))
        | F.coalesce(low.contains("authentication failure"), F.lit(False))
    )


def is_port_scan_attempt(port: Column, protocol: Column, action: Column) -> Column:
    return (
        port.isNotNull()
        & F.coalesce(protocol.isin("TCP", "UDP"), F.lit(False))
        & F.coalesce(F.lower(action).isin("drop", "reject"), F.lit(False))
    )


def url_path(url: Column) -> Column:
    """Path of a request target such as ``/a/b?x=1 HTTP/1.1``."""
    return F.regexp_extract(url, r"^([^\s?#]*)", 1)

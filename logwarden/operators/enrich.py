"""Joins with indicator, reputation and location tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import first_per_key, ladder, lookup, operator, text_list
from logwarden.functions import net

#: Patterns that one automaton holds, in characters; it takes some hundred bytes for each in every Python worker.
SHARD_CHARS = 1 << 20
_BUILT: dict[str, ahocorasick.Automaton] = {}


def _automaton(key: str, patterns: list[str]) -> ahocorasick.Automaton:
    """The automaton of a list, built once in a Python worker; that of another list is let go."""
    if key not in _BUILT:
        _BUILT.clear()
        built = ahocorasick.Automaton()
        for pattern in patterns:
            built.add_word(pattern, pattern)
        built.make_automaton()
        _BUILT[key] = built
    return _BUILT[key]


def _patterns_in(text: Column, patterns: list[str]) -> Column:
    """The different patterns that occur in a text, in time linear in the text and its hits."""
    key = uuid.uuid4().hex

    @F.pandas_udf("array<string>")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = _automaton(key, patterns)
        for batch in batches:
            yield pd.Series([sorted({p for _, p in automaton.iter(t)}) if t else [] for t in batch], dtype=object)

    return search(text)


@operator
def contains_join(texts: DataFrame, text: str, patterns: DataFrame, pattern: str, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """Pairs where ``pattern`` (non-empty) occurs in ``text``, ignoring case.

    The texts are searched once for all patterns by an Aho-Corasick automaton.  A list of more than ``shard_chars``
    characters is dealt by hash to several automata, each of which passes over the texts, so no task holds a list
    of unknown size.  The patterns found are then joined with their rows.  Null and empty patterns and texts meet nothing.
    """
    texts = texts.withColumn("_text", F.lower(text))
    patterns = patterns.withColumn("_pattern", F.lower(pattern)).where(F.col("_pattern") != "")
    listed = patterns.select("_pattern").distinct()
    shards = (listed.agg(F.coalesce(F.sum(F.length("_pattern")), F.lit(0))).first()[0] // shard_chars) + 1
    hits = None
    for shard in range(shards):
        # bounded by shard_chars and one pattern, up to the evenness of the hash
        words = [r[0] for r in listed.where(F.pmod(F.xxhash64("_pattern"), F.lit(shards)) == shard).collect()]
        if words:
            found = texts.withColumn("_pattern", F.explode(_patterns_in(F.col("_text"), words)))
            hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = texts.withColumn("_pattern", F.lit("")).limit(0)
    return hits.join(patterns, "_pattern").drop("_text", "_pattern")


# --- locations ------------------------------------------------------------------------

PLACE = ["country", "city", "latitude", "longitude", "country_code"]


def _place(values: tuple) -> Column:
    return F.struct(*[F.lit(v).alias(n) for n, v in zip(PLACE, values)])


def _private_place(ip: Column) -> Column:
    places = F.array(*map(_place, rules.PRIVATE_PLACES))
    private = F.lit(False)
    for prefix in rules.PRIVATE_PREFIXES:
        private = private | ip.startswith(prefix)
    return F.when(private, F.get(places, net.private_place_index(ip).cast("int")))


def network(number: Column, bits: Column) -> Column:
    """First address number of the block of ``bits`` leading bits that holds the address ``number``."""
    return number - F.pmod(number, F.pow(F.lit(2.0), F.lit(32) - bits).cast("bigint"))


def cidr_blocks(ranges: DataFrame, cidr: str = "cidr") -> DataFrame:
    """Prefix length (0 to 32) and first address number of every block."""
    part = F.split(cidr, "/")
    sized = ranges.withColumn("_bits", F.get(part, F.lit(1)).try_cast("int")).where(F.col("_bits").between(0, 32))
    return sized.withColumn("_network", network(net.ip_num(F.get(part, F.lit(0))), F.col("_bits")))


def place_of_ips(ips: DataFrame, exact: DataFrame | None, ranges: DataFrame | None) -> DataFrame:
    """(source_ip, place) for distinct addresses: exact row, else private place, else the smallest
    block that holds the address, else unknown."""
    ip = F.col("source_ip")
    found = ips.withColumn("_private", _private_place(ip))
    choices = []
    if exact is not None:
        rows = exact.select(F.col("ip").alias("source_ip"), F.struct(*PLACE).alias("_exact"))
        found = found.join(rows, "source_ip", "left")
        choices.append(F.col("_exact"))
    choices.append(F.col("_private"))
    if ranges is not None:
        blocks = cidr_blocks(ranges).select("_bits", "_network", F.struct(*PLACE).alias("_place"))
        # an address lies in one block of each length, so it meets only blocks that hold it; at most 33 lengths
        lengths = blocks.agg(F.collect_set("_bits")).scalar()
        numbered = ips.withColumn("_num", net.ip_num(ip)).withColumn("_bits", F.explode(lengths))
        smallest = (
            numbered.withColumn("_network", network(F.col("_num"), F.col("_bits")))
            .join(blocks, ["_bits", "_network"])
            .groupBy("source_ip")
            .agg(F.max_by("_place", "_bits").alias("_block"))
        )
        found = found.join(smallest, "source_ip", "left")
        choices.append(F.col("_block"))
    place = F.coalesce(*choices, _place(rules.UNKNOWN_PLACE))
    return found.select("source_ip", place.alias("_place"))


@operator
def geo_enrich(df: DataFrame, exact: DataFrame | None = None, ranges: DataFrame | None = None) -> DataFrame:
    """Country, city, latitude, longitude and country_code of ``source_ip``.

    ``exact`` has (ip, place columns), ``ranges`` (cidr, place columns).  Places are worked out once
    per distinct address and joined back.
    """
    places = place_of_ips(df.select("source_ip").where("source_ip IS NOT NULL").distinct(), exact, ranges)
    unknown = _place(rules.UNKNOWN_PLACE)
    return (
        df.join(places, "source_ip", "left")
        .withColumn("_place", F.coalesce("_place", unknown))
        .select(*df.columns, *[F.col(f"_place.{c}").alias(c) for c in PLACE])
    )


def _places_per_ip(threats: DataFrame, exact, ranges) -> DataFrame:
    per_ip = threats.groupBy("source_ip").agg(F.count("*").alias("n"))
    return geo_enrich(per_ip, exact, ranges)


@operator
def geo_top_countries(threats: DataFrame, exact=None, ranges=None, limit: int = 10) -> DataFrame:
    """Threats per known country with its code, most first."""
    known = _places_per_ip(threats, exact, ranges).where(F.col("country") != rules.UNKNOWN_PLACE[0])
    code = F.when(F.col("country_code") != rules.UNKNOWN_PLACE[4], F.col("country_code"))
    return (
        known.groupBy("country")
        .agg(F.sum("n").alias("threats"), F.coalesce(F.min(code), F.lit(rules.UNKNOWN_PLACE[4])).alias("country_code"))
        .orderBy(F.desc("threats"), "country")
        .limit(limit)
    )


@operator
def geo_top_cities(threats: DataFrame, exact=None, ranges=None, limit: int = 5) -> DataFrame:
    """The cities and the countries with most threats, as (section, name, threats)."""
    placed = _places_per_ip(threats, exact, ranges)
    tops = [
        placed.groupBy(F.col(name).alias("name"))
        .agg(F.sum("n").alias("threats"))
        .orderBy(F.desc("threats"), "name")
        .limit(limit)
        .select(F.lit(name).alias("section"), "name", "threats")
        for name in ("city", "country")
    ]
    return tops[0].unionByName(tops[1])


# --- indicators -----------------------------------------------------------------------


@operator
def ioc_exact_match(indicators: DataFrame, ioc: DataFrame) -> DataFrame:
    """Listed addresses and hashes: adds match, category and confidence to (indicator, indicator_type)."""
    listed = (
        ioc.where(F.col("ioc_type").isin("ip", "hash"))
        .select(F.lower("value").alias("_value"), F.col("ioc_type").alias("indicator_type"))
        .distinct()
        .withColumn("_listed", F.lit(True))
    )
    joined = indicators.withColumn("_value", F.lower("indicator")).join(listed, ["_value", "indicator_type"], "left")
    match = F.coalesce("_listed", F.lit(False))
    kind = F.col("indicator_type")
    return joined.select(
        *indicators.columns,
        match.alias("match"),
        F.when(match, lookup(kind, rules.IOC_CATEGORY, "")).alias("category"),
        F.when(match, lookup(kind, rules.IOC_CONFIDENCE, 0.0)).otherwise(F.lit(0.0)).alias("confidence"),
    )


@operator
def ioc_domain_match(indicators: DataFrame, ioc: DataFrame) -> DataFrame:
    """Domain indicators that contain a listed domain."""
    domains = ioc.where(F.col("ioc_type") == "domain").select(F.col("value").alias("_domain")).distinct()
    asked = indicators.where(F.col("indicator_type") == "domain").select("indicator", "indicator_type").distinct()
    hits = contains_join(asked, "indicator", domains, "_domain").select("indicator", "indicator_type").distinct()
    joined = indicators.join(hits.withColumn("_hit", F.lit(True)), ["indicator", "indicator_type"], "left")
    match = F.coalesce("_hit", F.lit(False))
    return joined.select(
        *indicators.columns,
        match.alias("match"),
        F.when(match, rules.IOC_CATEGORY["domain"]).alias("category"),
        F.when(match, F.lit(rules.IOC_CONFIDENCE["domain"])).otherwise(F.lit(0.0)).alias("confidence"),
    )


@operator
def ioc_partial_match(queries: DataFrame, ioc: DataFrame, value: str = "indicator") -> DataFrame:
    """For each asked value the first active indicator (lowest id) that contains it, ignoring case."""
    asked = queries.select(F.col(value).alias("_asked")).distinct()
    active = ioc.where("is_active").select(F.col("id").alias("ioc_id"), F.col("value").alias("ioc_value"))
    pairs = contains_join(active, "ioc_value", asked, "_asked")
    first = pairs.groupBy("_asked").agg(F.min_by(F.struct("ioc_id", "ioc_value"), "ioc_id").alias("_hit"))
    return queries.join(first, queries[value] == F.col("_asked"), "left").select(
        *queries.columns, F.col("_hit").isNotNull().alias("match"), "_hit.ioc_id", "_hit.ioc_value"
    )


@operator
def ioc_summary(ioc: DataFrame) -> DataFrame:
    """Indicators per class, and in total."""
    return ioc.groupBy("ioc_type").agg(F.count("*").alias("n")).unionByName(
        ioc.agg(F.lit("total").alias("ioc_type"), F.count("*").alias("n"))
    )


@operator
def ioc_maintain(ioc: DataFrame, additions: DataFrame | None = None, deactivate: DataFrame | None = None) -> DataFrame:
    """Add indicators and deactivate by id.  Addresses already listed are not added again; domains
    and hashes always are."""
    result = ioc
    if additions is not None:
        is_ip = F.col("ioc_type") == "ip"
        others = additions.where(~is_ip)
        fresh = first_per_key(additions.where(is_ip), ["value"], [F.asc("id")]).join(
            ioc.where(is_ip).select("value"), "value", "left_anti"
        )
        result = result.unionByName(others, allowMissingColumns=True).unionByName(fresh, allowMissingColumns=True)
    if deactivate is not None:
        ids = deactivate.select("id").distinct().withColumn("_off", F.lit(True))
        active = F.col("is_active") & F.col("_off").isNull()
        result = result.join(ids, "id", "left").withColumn("is_active", active).drop("_off")
    return result


@operator
def ioc_reputation(ips: DataFrame, ioc: DataFrame, threats: DataFrame, ip: str = "source_ip") -> DataFrame:
    """malicious if listed and active; else by the number of threats of the address."""
    listed = (
        ioc.where("is_active").groupBy(F.col("value").alias("_ip"))
        .agg(F.min_by("ioc_type", "id").alias("listed_as"), F.min("created_at").alias("first_seen"))
    )
    counts = threats.groupBy(F.col("source_ip").alias("_ip")).agg(F.count("*").alias("_n"))
    n = F.coalesce("_n", F.lit(0))
    hit = F.col("listed_as").isNotNull()
    return (
        ips.withColumn("_ip", F.col(ip)).join(listed, "_ip", "left").join(counts, "_ip", "left")
        .select(
            *ips.columns,
            F.when(hit, "malicious").when(n > 5, "suspicious").when(n > 0, "low_risk").otherwise("clean").alias("reputation"),
            F.when(hit, "high").when(n > 5, "medium").when(n > 0, "low").otherwise("high").alias("confidence"),
            n.alias("threat_count"),
            "listed_as",
            "first_seen",
            F.when(hit, F.lit(None).cast("string")).when(n > 5, "Monitor closely")
            .when(n > 0, "Occasional threats detected").otherwise("No threats detected").alias("recommendation"),
        )
    )


# --- reputation feeds -----------------------------------------------------------------


def _one_per_indicator(feed: DataFrame) -> DataFrame:
    """One row per indicator of a reputation feed, so that joins with it repeat nothing."""
    kinds = dict(feed.dtypes)
    # the most alarming row of each source gives the columns that belong together
    ratio = F.when(F.col("total") > 0, F.col("positives") / F.col("total")).otherwise(F.when(F.col("total").isNotNull(), -1.0))
    scanned = F.max(F.struct(ratio.alias("r"), "total", "positives")).alias("_scan")
    reported = F.max(F.struct("abuse_confidence", "country", "isp", "usage_type")).alias("_abuse")
    grouped = feed.groupBy("indicator").agg(scanned, reported, F.sum("total_reports").alias("total_reports"))
    return grouped.select(
        "indicator", F.col("_scan.positives").alias("positives"), F.col("_scan.total").alias("total"),
        F.col("_abuse.abuse_confidence").alias("abuse_confidence"), F.col("total_reports").cast(kinds["total_reports"]).alias("total_reports"),
        F.col("_abuse.country").alias("country"), F.col("_abuse.isp").alias("isp"), F.col("_abuse.usage_type").alias("usage_type"))


@operator
def intel_score(indicators: DataFrame, ioc: DataFrame, feed: DataFrame | None = None, require_match: bool = True) -> DataFrame:
    """Highest score over the sources of each (indicator, indicator_type).

    Sources are the local list, the detection ratio and, for addresses, the abuse confidence of
    ``feed``.  Feed rows carry no match flag, so with ``require_match`` only the list counts.  Of several feed rows
    for one indicator the highest ratio and the highest abuse confidence count, and reports are summed.
    """
    local = ioc_exact_match(indicators, ioc)
    domains = ioc_domain_match(indicators.select("indicator", "indicator_type").distinct(), ioc).select(
        "indicator", "indicator_type", F.col("category").alias("_dc"), F.col("confidence").alias("_d")
    )
    joined = local.join(domains, ["indicator", "indicator_type"], "left").withColumns(
        {
            "category": F.coalesce("category", "_dc"),
            "local_confidence": F.greatest("confidence", F.coalesce("_d", F.lit(0.0))),
        }
    )
    facts = ["positives", "total", "abuse_confidence", "total_reports", "country", "isp", "usage_type"]
    if feed is None:
        joined = joined.withColumns({c: F.lit(None) for c in facts})
    else:
        joined = joined.join(_one_per_indicator(feed.select("indicator", *facts)), "indicator", "left")
    is_ip = F.col("indicator_type") == "ip"
    ratio = F.when(F.col("total") > 0, F.col("positives") / F.col("total") * 100)
    abuse = F.when(is_ip, F.col("abuse_confidence"))
    score = F.col("local_confidence") * 100
    if not require_match:
        score = F.greatest(score, F.coalesce(ratio, F.lit(0.0)), F.coalesce(abuse, F.lit(0.0)))
    sources = F.array_compact(
        F.array(
            F.lit("local"),
            F.when(F.col("total").isNotNull(), "virustotal"),
            F.when(F.col("abuse_confidence").isNotNull() & is_ip, "abuseipdb"),
        )
    )
    return joined.select(
        *indicators.columns, score.alias("overall_score"), sources.alias("sources"), "category", *facts
    )


@operator
def intel_verdict(df: DataFrame) -> DataFrame:
    return df.withColumn("verdict", ladder(F.col("overall_score"), rules.VERDICT_BANDS))


@operator
def intel_details(scored: DataFrame) -> DataFrame:
    """Per indicator the different countries, providers, usage types and categories, and all reports."""

    def distinct(column: str) -> Column:
        return F.sort_array(F.collect_set(column))

    return scored.groupBy("indicator").agg(
        distinct("country").alias("countries"),
        distinct("isp").alias("isps"),
        distinct("usage_type").alias("usage_types"),
        distinct("category").alias("categories"),
        F.coalesce(F.sum("total_reports"), F.lit(0)).alias("reports"),
    )


@operator
def intel_batch(indicators: DataFrame, ioc: DataFrame, feed: DataFrame | None = None, require_match: bool = True) -> DataFrame:
    """Typed, scored and judged indicators with the facts behind them; one row per asked row."""
    asked = indicators.select("indicator").distinct().withColumn("indicator_type", net.indicator_type(F.col("indicator")))
    judged = intel_verdict(intel_score(asked, ioc, feed, require_match))
    answers = judged.select(
        "indicator", "indicator_type", "overall_score", "verdict", "sources", "category", "country", "isp", "usage_type",
        F.coalesce("total_reports", F.lit(0)).alias("reports"),
    )
    return indicators.join(answers, "indicator")


@operator
def intel_search(
    indicators: DataFrame,
    ioc: DataFrame,
    feed: DataFrame | None = None,
    require_match: bool = True,
    min_score: float = 0,
    max_score: float = 100,
    verdicts: list[str] | None = None,
    sources: list[str] | None = None,
) -> DataFrame:
    """:func:`intel_batch` within a score range, any of the verdicts, any of the sources."""
    rows = intel_batch(indicators, ioc, feed, require_match).where(F.col("overall_score").between(min_score, max_score))
    if verdicts:
        rows = rows.where(F.col("verdict").isin(verdicts))
    if sources:
        rows = rows.where(F.arrays_overlap("sources", text_list(sources)))
    return rows


def _hunted(threats: DataFrame, ioc: DataFrame, feed: DataFrame | None, require_match: bool) -> DataFrame:
    ips = threats.select(F.col("source_ip").alias("indicator")).distinct().withColumn("indicator_type", F.lit("ip"))
    intel = intel_verdict(intel_score(ips, ioc, feed, require_match))
    verdict, advice = F.col("verdict"), rules.HUNTING_ADVICE
    none = text_list([])
    positives = F.coalesce(F.col("positives"), F.lit(0)) > 0
    recommendations = F.concat(
        F.when(verdict == "malicious", text_list(advice["isolate"])).otherwise(none),
        F.when(verdict.isin("malicious", "suspicious"), text_list(advice["review"])).otherwise(none),
        F.when(positives, text_list(advice["cross_reference"])).otherwise(none),
        F.when(F.coalesce(F.col("total_reports"), F.lit(0)) > 10, text_list(advice["block"])).otherwise(none),
    )
    judged = intel.select(
        F.col("indicator").alias("source_ip"), "overall_score", "verdict",
        ladder(F.col("overall_score"), rules.PRIORITY_BANDS).alias("priority"),
        recommendations.alias("recommendations"),
    )
    return threats.select(F.col("id").alias("threat_id"), "source_ip", "threat_type", "risk_score").join(judged, "source_ip")


@operator
def threat_hunting(threats, ioc, feed=None, require_match: bool = True, limit: int = 20) -> DataFrame:
    """Threats with the intelligence of their address, most urgent first.  Each distinct address is
    judged once."""
    rank = lookup(F.col("priority"), {"critical": 0, "high": 1, "medium": 2}, 3)
    return _hunted(threats, ioc, feed, require_match).orderBy(rank, F.desc("risk_score"), "threat_id").limit(limit)


@operator
def threat_hunting_stats(threats, ioc, feed=None, require_match: bool = True) -> DataFrame:
    """Threats per priority: counted per address first."""
    per_ip = threats.groupBy("source_ip").agg(F.count("*").alias("n"))
    ips = per_ip.withColumns({"indicator": F.col("source_ip"), "indicator_type": F.lit("ip")})
    scored = intel_score(ips, ioc, feed, require_match)
    priority = ladder(F.col("overall_score"), rules.PRIORITY_BANDS)
    return scored.groupBy(priority.alias("priority")).agg(F.sum("n").alias("threats"))


# --- blocked addresses ----------------------------------------------------------------


@operator
def blocklist_build(threats: DataFrame, ioc: DataFrame | None = None, threshold: float = rules.AUTO_BLOCK_THRESHOLD) -> DataFrame:
    """Addresses to block, with the reason given by their first threat at or above the threshold;
    addresses that were ever listed as blocked are skipped."""
    reason = F.format_string("Auto-blocked: risk score %.1f for %s", "risk_score", "threat_type")
    first = (
        threats.where((F.col("risk_score") >= threshold) & (F.coalesce("source_ip", F.lit("")) != ""))
        .groupBy(F.col("source_ip").alias("value"))
        .agg(F.min_by(F.struct(reason.alias("description"), F.col("timestamp").alias("created_at")),
                      F.struct("timestamp", "id")).alias("_first"))
    )
    rows = first.select(
        F.lit("blocked_ip").alias("ioc_type"), "value", "_first.description", F.lit("critical").alias("threat_level"),
        F.lit("auto-block").alias("source"), F.lit("system").alias("added_by"), "_first.created_at", F.lit(True).alias("is_active"),
    )
    if ioc is None:
        return rows
    return rows.join(ioc.where("ioc_type = 'blocked_ip'").select("value"), "value", "left_anti").select(*rows.columns)


@operator
def blocklist_change(ioc: DataFrame, add: DataFrame | None = None, remove: DataFrame | None = None) -> DataFrame:
    """Block or unblock addresses by hand: ``add`` has (ip, reason, created_at), ``remove`` (ip)."""
    result = ioc
    if add is not None:
        known = ioc.where("ioc_type = 'blocked_ip'").select(F.col("value").alias("ip"))
        fresh = first_per_key(add, ["ip"], [F.asc("created_at")]).join(known, "ip", "left_anti")
        rows = fresh.select(
            F.lit("blocked_ip").alias("ioc_type"), F.col("ip").alias("value"),
            F.coalesce("reason", F.lit("Manually blocked by analyst")).alias("description"),
            F.lit("critical").alias("threat_level"), F.lit("auto-block").alias("source"),
            F.lit("system").alias("added_by"), "created_at", F.lit(True).alias("is_active"),
        )
        result = result.unionByName(rows, allowMissingColumns=True)
    if remove is not None:
        gone = remove.select(F.col("ip").alias("value")).distinct().withColumn("_off", F.lit(True))
        off = F.col("_off").isNotNull() & (F.col("ioc_type") == "blocked_ip")
        result = result.join(gone, "value", "left").withColumn("is_active", F.col("is_active") & ~off).drop("_off")
    return result


@operator
def blocklist_apply(df: DataFrame, blocklist: DataFrame, mode: str = "tag") -> DataFrame:
    """Traffic of blocked addresses: ``tag`` adds is_blocked, ``drop`` removes it, ``keep`` keeps only it."""
    active = blocklist.where("ioc_type = 'blocked_ip' AND is_active").select(F.col("value").alias("source_ip")).distinct()
    if mode == "drop":
        return df.join(active, "source_ip", "left_anti").select(*df.columns)
    if mode == "keep":
        return df.join(active, "source_ip", "left_semi").select(*df.columns)
    return df.join(active.withColumn("_b", F.lit(True)), "source_ip", "left").select(
        *df.columns, F.coalesce("_b", F.lit(False)).alias("is_blocked")
    )

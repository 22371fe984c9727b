"""URL filter: a blocked Bloom filter of the listed URLs, then an exact join that removes false positives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blocks of 8 words of 32 bits, one bit set in each word: about 0.1 % false positives at 16 bits a key.
WORDS = 8
#: The filter never has more blocks than this, so its broadcast stays below about 8 MB whatever the list's length.
MAX_BLOCKS = 1 << 16

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Canonical host and path: host between ``://`` and the next ``/``, ``?`` or ``#`` with A-Z lower-cased, path up to ``?`` or ``#``.

    Both are empty for a null url or one without ``://``.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(tail, "^[^?#]*", 0)


def _key(host: Column, path: Column) -> Column:
    # a host has no slash and a path starts with one or is empty
    return F.concat(host, path)


def hashed_key(key: str, blocks: int) -> list[Column]:
    """Block of a key and, in b0 … b7, the bit it sets in each word of the block."""
    words = [F.expr(f"shiftleft(1L, cast(shiftright(xxhash64(7, {key}), {5 * i}) & 31 as int))").alias(f"b{i}") for i in range(WORDS)]
    return [F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block"), *words]


def bloom_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """Rows (block, w0 … w7), at most ``blocks``; the words of a block are the OR of its keys' bits."""
    return keys.select(*hashed_key(key, blocks)).groupBy("block").agg(*[F.bit_or(f"b{i}").alias(f"w{i}") for i in range(WORDS)])


def url_filter(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, url, host, path, rule and verdict.

    ``rules`` has host, path and verdict.  A rule fits its host and all its subdomains where the page's path starts
    with the rule's path.  The longest rule (host and path together, then the longer host, then the smaller verdict)
    wins; a page that no rule fits has a null rule and the ``default`` verdict.

    A rule can only fit a page at one key: the last k labels of the host and the first n characters of the path, where
    k and n are the rule's own.  So each page is asked about once for every (k, n) that occurs in the list.  Keys
    whose bits are not all set in the blocked Bloom filter are dropped in the scan's own task; the rest, hits and the
    few false positives, meet the rules in an exact join.  Every distinct url is judged once and its verdict joined
    back, so a frequent url costs no more than a rare one.

    A null url, or one without ``://``, has an empty host and path and fits no rule.  Repeated pages are judged alike;
    other columns are not read.  A rule with a null host or path fits nothing.
    """
    listed = rules.where("host IS NOT NULL AND path IS NOT NULL").select(
        F.translate(F.col("host"), _UPPER, _LOWER).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    listed = listed.withColumn("key", _key(F.col("rule_host"), F.col("rule_path")))
    shape = F.struct(F.size(F.split("rule_host", r"\.")).alias("k"), F.length("rule_path").alias("n"))
    # one entry per label count and path length, both limited by what a URL may hold
    facts = listed.agg(F.collect_set(shape).alias("shapes"), F.count("*").alias("n")).first()
    blocks = 1
    while blocks < MAX_BLOCKS and blocks * 16 < facts["n"]:
        blocks *= 2
    bloom = bloom_filter(listed, "key", blocks)

    host, path = url_parts(F.col("url"))
    asked = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    urls = asked.where("url IS NOT NULL").select("url").distinct().withColumns({"host": host, "path": path})
    each = [F.when(F.length("path") >= s["n"], _key(F.substring_index("host", ".", -s["k"]), F.substring("path", 1, s["n"])))
            for s in facts["shapes"]] or [F.lit(None).cast("string")]
    keys = urls.select("url", "host", F.explode(F.array_distinct(F.array(*each))).alias("key")).where("key IS NOT NULL")
    passed = keys.select("*", *hashed_key("key", blocks)).join(F.broadcast(bloom), "block")  # bounded by MAX_BLOCKS
    passed = passed.where(" AND ".join(f"w{i} & b{i} = b{i}" for i in range(WORDS)))
    # the key alone could join a rule's host to the end of a longer path
    fits = (F.col("host") == F.col("rule_host")) | F.endswith(F.col("host"), F.concat(F.lit("."), F.col("rule_host")))
    exact = passed.select("url", "host", "key").join(listed, "key").where(fits)
    longest = F.max_by(F.struct("key", "rule_verdict"), F.struct(F.length("key"), F.length("rule_host"), F.expr("rule_verdict = 'allow'")))
    hits = exact.groupBy("url").agg(longest.alias("best"))
    hits = hits.select("url", F.col("best.key").alias("rule"), F.col("best.rule_verdict").alias("verdict"))
    return asked.join(hits, "url", "left").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), host.alias("host"), path.alias("path"), "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"))

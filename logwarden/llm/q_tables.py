"""Registered queries of the operators that SQL can express, with their SQL, and of byte-level BPE and sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logwarden.llm.bpe import tokenize
from logwarden.llm.common import table
from logwarden.llm.exact_dedup import exact_dedup
from logwarden.llm.mixing import mix_sources
from logwarden.llm.sharding import shard_rows
from logwarden.llm.url_filter import url_filter

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_rows(table(spark, sf_dir, "documents"), shards=24)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), weights=(3, 1, 2), budget_ratio=1.5, max_repeats=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter(table(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def vocabulary() -> tuple[str, str]:
    import public_tokenizers

    with open(public_tokenizers.path(VOCABULARY)) as file:
        return file.read(), public_tokenizers.PATTERN


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = tokenize(table(spark, sf_dir, "documents"), *vocabulary())
    return tokens.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {
    "op2_exact_dedup": op2_exact_dedup, "op6_sharding": op6_sharding, "op7_mixing": op7_mixing, "op8_url_filter": op8_url_filter,
    "op10_byte_bpe": op10_byte_bpe,
}

ORACLE = {
    "op2_exact_dedup": r"""
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size,
               row_number() OVER w = 1 AS kept, sha AS text_sha256
        FROM d WINDOW w AS (PARTITION BY sha ORDER BY chars DESC, doc_id)""",
    "op7_mixing": r"""
        WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                          ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12))::BIGINT AS h FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        r AS (SELECT *, 2 * source_size AS lim,
                     [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::DOUBLE AS weight FROM s),
        l AS (SELECT *, ((SELECT sum(source_size) FROM s)::DOUBLE * 1.5::DOUBLE
                         - coalesce(sum(lim) OVER (ORDER BY lim / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                        / sum(weight) OVER (ORDER BY lim / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
                     row_number() OVER (ORDER BY lim / weight, source) AS spot FROM r),
        f AS (SELECT level AS fit FROM l WHERE level <= lim / weight ORDER BY spot LIMIT 1),
        t AS (SELECT source, source_size, least(lim::DOUBLE, coalesce((SELECT fit FROM f) * weight, lim::DOUBLE)) AS target FROM l),
        b AS (SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 2) ELSE 0 END::BIGINT AS full_times FROM t),
        c AS (SELECT source, h, sum(size) AS n FROM d GROUP BY source, h),
        e AS (SELECT c.source, c.h, n, target - full_times * source_size AS budget, sum(n) OVER (PARTITION BY c.source ORDER BY h) AS reached
              FROM c JOIN b ON c.source IS NOT DISTINCT FROM b.source),
        x AS (SELECT *, row_number() OVER (PARTITION BY source, reached > budget ORDER BY h) AS past FROM e),
        y AS (SELECT source, h, CASE WHEN budget > 0 AND (reached <= budget OR (past = 1 AND reached - budget < budget - (reached - n))) THEN 1 ELSE 0 END AS extra FROM x)
        SELECT d.doc_id, d.size::BIGINT AS size, b.source_size, b.target, (least(full_times + extra, 2) * d.size)::BIGINT AS taken
        FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN y ON d.source IS NOT DISTINCT FROM y.source AND d.h = y.h""",
    "op8_url_filter": r"""
        WITH rules(rhost, rpath, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        q AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM p),
        u AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM q),
        m AS (SELECT page_id, host, path, rhost || rpath AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC) AS k
              FROM u JOIN rules ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath))
        SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.v, 'allow') AS verdict FROM u LEFT JOIN m ON u.page_id = m.page_id AND m.k = 1""",
}

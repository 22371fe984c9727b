"""Registered query of phrase mining and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logwarden.llm.common import table
from logwarden.llm.phrases import phrases


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases(table(spark, sf_dir, "documents"), min_count=10, top=2000, subsumed_percent=50)


QUERIES = {"op12_phrases": op12_phrases}

ORACLE = {
    "op12_phrases": r"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents WHERE text IS NOT NULL),
        p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
        s AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
        i AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS k FROM s),
        w AS (SELECT lang, ws[k] AS w1, ws[k + 1] AS w2, ws[k + 2] AS w3 FROM i),
        f1 AS (SELECT lang, w1, count(*) AS f FROM w GROUP BY ALL),
        f2 AS (SELECT lang, w1, w2, count(*) AS f FROM w WHERE w2 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
        f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM w WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10),
        total AS (SELECT lang, sum(f)::BIGINT AS n FROM f1 GROUP BY lang),
        longer AS (SELECT lang, a, b, max(f) AS f FROM (SELECT lang, w1 AS a, w2 AS b, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) GROUP BY ALL),
        cuts AS (
            SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, 1 AS k, f2.f AS a, x.f AS l, y.f AS r
            FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
                 LEFT JOIN longer m ON m.lang = f2.lang AND m.a = f2.w1 AND m.b = f2.w2
            WHERE m.f IS NULL OR 100 * m.f < 50 * f2.f
            UNION ALL
            SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 1, f3.f, x.f, y.f
            FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1 JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
            UNION ALL
            SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, 2, f3.f, x.f, y.f
            FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2 JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3),
        scored AS (SELECT *, ((1000000::HUGEINT * a * a) // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
        best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS cut FROM scored),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE cut = 1)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
}

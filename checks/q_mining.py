"""Association rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.shape import flat
from checks.sqlviews import day, flow, threat
from logwarden.operators import mining as op
from logwarden.plans import views as v

HOURS = 168
FLOW_FEATURES = v.FLOW_FEATURES


def hourly(s, d):
    return op.rules_tx_hour(v.v_threat(s, d), hours=HOURS)


def rule_rows(df):
    return flat(df, "array_join(antecedents, '+') AS antecedents", "array_join(consequents, '+') AS consequents", "support", "confidence", "lift")


def set_rows(df):
    return flat(df, "array_join(items, '+') AS items", "freq", "support")


def two_valued(s, d):
    """Flows with the quantity cut into two values, so that thirds and halves have repeated edges."""
    return v.v_flow(s, d).withColumn("l_quantity", F.when(F.col("l_quantity") > 20, 1.0).otherwise(0.0))


QUERIES = {
    "rules_tx_hour": lambda s, d: flat(hourly(s, d), "bucket", "items"),
    "rules_tx_day": lambda s, d: flat(op.rules_tx_day(v.v_threat(s, d), hours=HOURS), "bucket", "items"),
    "rules_auto_bucket": lambda s, d: flat(op.rules_auto_bucket(v.v_threat(s, d), hours=HOURS), "bucket_used", "bucket", "items"),
    "rules_auto_bucket_day": lambda s, d: flat(
        # one threat type per hour, several per day
        op.rules_auto_bucket(
            v.v_threat(s, d).where("(hour(timestamp) % 2 = 0 AND threat_type = 'ddos') OR (hour(timestamp) % 2 = 1 AND threat_type = 'anomaly')"),
            hours=HOURS),
        "bucket_used", "bucket", "items"),
    "rules_min_support_default": lambda s, d: flat(op.rules_min_support_default(hourly(s, d))),
    "rules_itemsets": lambda s, d: set_rows(op.rules_itemsets(hourly(s, d))),
    "rules_association": lambda s, d: rule_rows(op.rules_association(op.rules_itemsets(hourly(s, d)), min_confidence=0.28, max_rules=40)),
    "rules_association_all": lambda s, d: rule_rows(op.rules_association(op.rules_itemsets(hourly(s, d)), min_confidence=0.0, max_rules=None)),
    "rules_pairwise": lambda s, d: flat(op.rules_pairwise(hourly(s, d), min_confidence=0.28, max_rules=30)),
    "rules_flow_bins": lambda s, d: flat(
        op.rules_flow_bins(v.v_flow(s, d), FLOW_FEATURES).groupBy(F.array_join("items", "+").alias("items")).agg(F.count("*").alias("n"))),
    "rules_flow_bins_repeated": lambda s, d: flat(
        op.rules_flow_bins(two_valued(s, d), ["l_quantity", "l_extendedprice"])
        .groupBy(F.array_join("items", "+").alias("items")).agg(F.count("*").alias("n"))),
    "rules_flow": lambda s, d: rule_rows(op.rules_flow(v.v_flow(s, d), FLOW_FEATURES, min_support=0.05, min_confidence=0.3, max_rules=None)),
}

LAST = "(SELECT max(ts) FROM v_threat)"


def tx(unit: str) -> str:
    return f"""tx AS (SELECT date_trunc('{unit}', ts) AS bucket, list_sort(list(DISTINCT threat_type)) AS items FROM v_threat
      WHERE ts >= {LAST} - INTERVAL {HOURS} HOUR GROUP BY 1)"""


def itemset_sql(support: str, max_size: int = 5) -> str:
    """Itemsets of all sizes by repeated self joins of (transaction, item); equal transactions are joined once, with a weight."""
    parts = []
    for k in range(1, max_size + 1):
        joins = "".join(f" JOIN ti i{j} ON i{j}.t = i1.t AND i{j}.x > i{j - 1}.x" for j in range(2, k + 1))
        text = " || '+' || ".join(f"i{j}.x" for j in range(1, k + 1))
        lists = ", ".join(f"i{j}.x" for j in range(1, k + 1))
        parts.append(f"SELECT [{lists}] AS xs, {text} AS items, sum(i1.weight)::BIGINT AS freq FROM ti i1{joins} GROUP BY ALL")
    return f"""n AS (SELECT count(*) AS n FROM tx),
      gx AS (SELECT items, count(*) AS weight FROM tx GROUP BY items),
      ti AS (SELECT t, x, weight FROM (SELECT row_number() OVER () AS t, items, weight FROM gx), unnest(items) AS u(x)),
      fi AS (SELECT xs, items, freq, freq * 1e0 / n AS support FROM ({' UNION ALL '.join(parts)}), n WHERE freq * 1e0 / n >= {support})"""


RULES = """splits AS (
  SELECT a.xs AS ante, list_filter(f.xs, lambda x: NOT list_contains(a.xs, x)) AS cons, f.support, a.support AS sa
  FROM fi f JOIN fi a ON len(a.xs) < len(f.xs) AND list_has_all(f.xs, a.xs)),
ruled AS (
  SELECT array_to_string(ante, '+') AS antecedents, array_to_string(cons, '+') AS consequents, s.support, s.support / s.sa AS confidence,
    s.support / s.sa / c.support AS lift, ante, cons FROM splits s JOIN fi c ON c.xs = s.cons)"""
DEFAULT = "(SELECT greatest(0.02e0, least(0.5e0, 2e0 / n)) FROM n)"
OUT = "antecedents, consequents, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift"


def bins(column: str, source: str, name: str | None = None) -> str:
    name = name or column
    q1, q2 = f"(SELECT quantile_cont({column}, 1/3.0) FROM {source})", f"(SELECT quantile_cont({column}, 2/3.0) FROM {source})"
    return f"'{name}=' || CASE WHEN {column} <= {q1} THEN 'lo' WHEN {column} <= {q2} THEN 'mid' ELSE 'hi' END"


OUTCOME = "CASE WHEN is_attack = 1 THEN 'outcome_attack' ELSE 'outcome_normal' END"
BINNED = ", ".join(f"{bins(c, 'v_flow')} AS b_{c}" for c in FLOW_FEATURES)
FLOW_TX = f"tx AS (SELECT list_sort([{', '.join('b_' + c for c in FLOW_FEATURES)}, o]) AS items FROM (SELECT {BINNED}, {OUTCOME} AS o FROM v_flow))"

ORACLE = {
    "rules_tx_hour": threat(f", {tx('hour')} SELECT {day('bucket')} AS bucket, array_to_string(items, '|') AS items FROM tx"),
    "rules_tx_day": threat(f", {tx('day')} SELECT {day('bucket')} AS bucket, array_to_string(items, '|') AS items FROM tx"),
    "rules_auto_bucket": threat(f", {tx('hour')} SELECT 'hour' AS bucket_used, {day('bucket')} AS bucket, array_to_string(items, '|') AS items FROM tx"),
    "rules_auto_bucket_day": threat(f"""
        , chosen AS (SELECT * FROM v_threat WHERE (hour(ts) % 2 = 0 AND threat_type = 'ddos') OR (hour(ts) % 2 = 1 AND threat_type = 'anomaly'))
        SELECT 'day' AS bucket_used, {day("date_trunc('day', ts)")} AS bucket, array_to_string(list_sort(list(DISTINCT threat_type)), '|') AS items
        FROM chosen WHERE ts >= (SELECT max(ts) FROM chosen) - INTERVAL {HOURS} HOUR GROUP BY date_trunc('day', ts)"""),
    "rules_min_support_default": threat(f", {tx('hour')} SELECT count(*) AS n, round(greatest(0.02e0, least(0.5e0, 2e0 / count(*))), 6) AS min_support FROM tx"),
    "rules_itemsets": threat(f", {tx('hour')}, {itemset_sql(DEFAULT)} SELECT items, freq, round(support, 6) AS support FROM fi"),
    "rules_association": threat(f""", {tx('hour')}, {itemset_sql(DEFAULT)}, {RULES}
        SELECT {OUT} FROM ruled r WHERE r.confidence >= 0.28 ORDER BY r.confidence DESC, r.support DESC, ante, cons LIMIT 40"""),
    "rules_association_all": threat(f", {tx('hour')}, {itemset_sql(DEFAULT)}, {RULES} SELECT {OUT} FROM ruled"),
    "rules_pairwise": threat(f""", {tx('hour')}, {itemset_sql('0', 2)},
        one AS (SELECT xs[1] AS x, freq AS c FROM fi WHERE len(xs) = 1),
        p AS (SELECT xs[1] AS a, xs[2] AS b, freq AS c FROM fi WHERE len(xs) = 2 ORDER BY freq DESC, a, b LIMIT 200),
        j AS (SELECT p.*, oa.c AS ca, ob.c AS cb, n.n AS n FROM p JOIN one oa ON oa.x = a JOIN one ob ON ob.x = b, n),
        r AS (SELECT a AS antecedent, b AS consequent, c * 1e0 / n AS support, c * 1e0 / ca AS confidence, (c * 1e0 / ca) / (cb * 1e0 / n) AS lift FROM j
          UNION ALL SELECT b, a, c * 1e0 / n, c * 1e0 / cb, (c * 1e0 / cb) / (ca * 1e0 / n) FROM j WHERE c * 1e0 / cb <> c * 1e0 / ca)
        SELECT antecedent, consequent, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM r
        WHERE r.support >= {DEFAULT} AND r.confidence >= 0.28 ORDER BY r.confidence DESC, r.support DESC, antecedent, consequent LIMIT 30"""),
    "rules_flow_bins": flow(f"""
        SELECT {" || '+' || ".join('b_' + c for c in FLOW_FEATURES)} || '+' || o AS items, count(*) AS n
        FROM (SELECT {BINNED}, {OUTCOME} AS o FROM v_flow) GROUP BY 1"""),
    "rules_flow_bins_repeated": flow(f"""
        
        SELECT {bins('l_extendedprice', 'v_flow')} || '+' || {OUTCOME} AS items, count(*) AS n FROM v_flow GROUP BY 1"""),
    "rules_flow": flow(f", {FLOW_TX}, {itemset_sql('0.05e0', 6)}, {RULES} SELECT {OUT} FROM ruled r WHERE r.confidence >= 0.3"),
}

"""Flow labels, split, models; the anomaly detector."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.shape import flat, scratch
from checks.sqlviews import flow
from logwarden import rules
from logwarden.operators import detect
from logwarden.operators import flows as op
from logwarden.plans import views as v

FEATURES = v.FLOW_FEATURES
TREES, DEPTH = 200, None  # the reference sets no depth


def split(s, d):
    return op.flow_stratified_split(v.v_flow(s, d))


def train(s, d):
    return split(s, d).where("NOT is_test")


def forest(s, d):
    return op.flow_random_forest(train(s, d), FEATURES, trees=TREES, depth=DEPTH)


def guessed(s, d):
    """Predictions made by a fixed rule, so that their evaluation has a known answer."""
    return v.v_flow(s, d).withColumn("prediction", (F.col("l_quantity") > 30).cast("double"))


def planted(s, d):
    """Flows whose label follows from the features, up to a narrow seam, so that a forest can learn it."""
    rule = "l_quantity > 40 AND l_discount < 0.035 OR l_linenumber > 5 AND l_tax > 0.055"
    return split(s, d).withColumn("is_attack", F.expr(rule).cast("int"))


def planted_recall(s, d):
    rows = planted(s, d)
    model = op.flow_random_forest(rows.where("NOT is_test"), FEATURES, trees=TREES, depth=DEPTH)
    return op.flow_evaluate(model.transform(rows.where("is_test")))


def stored_model(s, d):
    path = scratch(s, "model")
    model, trees = forest(s, d), op.flow_iforest_fit(train(s, d), FEATURES)
    op.flow_model_save(s, path, model, trees, op.fit_standardize(train(s, d), FEATURES))
    loaded, loaded_trees, _ = op.flow_model_load(s, path)
    rows = v.v_flow(s, d)
    before = op.flow_predict(rows, model, trees).groupBy("confidence").agg(F.count("*").alias("n"), F.round(F.sum("risk"), 2).alias("risk"))
    after = op.flow_predict(rows, loaded, loaded_trees).groupBy("confidence").agg(F.count("*").alias("m"), F.round(F.sum("risk"), 2).alias("again"))
    return flat(before.join(after, "confidence"), "confidence", "n", "n = m AND risk = again AS same")


def predict_properties(s, d):
    """Every flow is judged; the parts of each verdict agree with one another."""
    rows = op.flow_predict(v.v_flow(s, d), forest(s, d), op.flow_iforest_fit(train(s, d), FEATURES))
    agree = "is_attack_predicted = (p > 0.5 OR p > 0.4 AND is_anomaly) AND abs(risk - least(10, p * 10)) < 0.00501"
    level = "confidence = CASE WHEN risk >= 7 THEN 'HIGH' WHEN risk >= 4 THEN 'MEDIUM' ELSE 'LOW' END"
    return rows.agg(F.count("*").alias("n"), F.expr("bool_and(p BETWEEN 0 AND 1)").alias("in_range"), F.expr(f"bool_and({agree} AND {level})").alias("agree"))


QUERIES = {
    "flow_label_map": lambda s, d: flat(
        op.flow_label_map(v.v_flow_label(s, d)).groupBy("Label", "Attack_Type", "is_attack").agg(F.count("*").alias("n"))),
    "flow_class_distribution": lambda s, d: flat(
        op.flow_class_distribution(op.flow_label_map(v.v_flow_label(s, d))), "Attack_Type", "n", "attack_share"),
    "flow_stratified_split": lambda s, d: flat(
        split(s, d).groupBy("is_attack", "is_test").agg(F.count("*").alias("n"))),
    "flow_standardize": lambda s, d: flat(
        op.flow_standardize(v.v_flow(s, d), op.fit_standardize(v.v_flow(s, d).where("l_discount < 0.05"), FEATURES)).select(*FEATURES)),
    "flow_random_forest": lambda s, d: flat(
        op.flow_evaluate(forest(s, d).transform(split(s, d).where("is_test"))), "tp + fp + fn + tn AS n", "accuracy BETWEEN 0 AND 100 AS valid"),
    "flow_iforest_fit": lambda s, d: s.createDataFrame(
        [(i, len(t["feature"])) for i, t in enumerate(op.flow_iforest_fit(train(s, d), FEATURES).trees)], "tree int, nodes int"),
    "flow_iforest_score": lambda s, d: flat(
        op.flow_iforest_score(v.v_flow(s, d), op.flow_iforest_fit(train(s, d), FEATURES)), "flow_id", "anomaly_score", "is_anomaly"),
    "flow_evaluate": lambda s, d: flat(op.flow_evaluate(guessed(s, d))),
    "flow_class_report": lambda s, d: flat(op.flow_class_report(guessed(s, d))),
    "flow_feature_importance": lambda s, d: flat(op.flow_feature_importance(s, forest(s, d))),
    "flow_feature_importance_sum": lambda s, d: flat(
        op.flow_feature_importance(s, forest(s, d), None).agg(
            F.count("*").alias("n"), F.round(F.sum("importance"), 6).alias("whole"), F.expr("bool_and(importance > 0)").alias("positive"))),
    "flow_random_forest_planted": lambda s, d: flat(
        planted_recall(s, d), "tp + fp + fn + tn AS n", "recall > 97 AS found", "precision > 97 AS clean"),
    "flow_predict_properties": lambda s, d: flat(predict_properties(s, d)),
    "flow_model_store_same": lambda s, d: stored_model(s, d).agg(F.sum("n").alias("n"), F.expr("bool_and(same)").alias("same")),
    "flow_predict": lambda s, d: flat(
        op.flow_predict(v.v_flow(s, d), forest(s, d), op.flow_iforest_fit(train(s, d), FEATURES)),
        "flow_id", "p", "is_attack_predicted", "risk", "confidence"),
    "flow_combine": lambda s, d: flat(
        op.flow_combine(v.v_flow(s, d).withColumn("p", F.col("l_quantity") / 50).withColumn("is_anomaly", F.col("l_linenumber") > 4))
        .groupBy("l_quantity", "l_linenumber", "is_attack_predicted", "risk", "confidence").agg(F.count("*").alias("n"))),
    "flow_model_store": stored_model,
    "detect_anomalies": lambda s, d: flat(
        detect.detect_anomalies(v.v_log(s, d), last_n=None), "source_ip", "risk_score", "details.anomaly_count"),
    "detect_anomalies_latest": lambda s, d: flat(
        detect.detect_anomalies(v.v_log(s, d), last_n=rules.ANOMALY_LAST_N), "source_ip", "risk_score", "details.anomaly_count"),
}

LABEL = "CASE flags WHEN 'AF' THEN 'DoS Hulk' WHEN 'AO' THEN 'PortScan' WHEN 'RF' THEN 'Web Attack – XSS' WHEN 'RO' THEN 'Strange' ELSE 'BENIGN' END"
KIND = "CASE flags WHEN 'AF' THEN 'DoS Attack' WHEN 'AO' THEN 'Port Scan' WHEN 'RF' THEN 'XSS' WHEN 'RO' THEN 'Unknown' ELSE 'Normal' END"
CELLS = """c AS (SELECT count(*) FILTER (is_attack = 1 AND l_quantity > 30) AS tp, count(*) FILTER (is_attack = 0 AND l_quantity > 30) AS fp,
  count(*) FILTER (is_attack = 1 AND l_quantity <= 30) AS fn, count(*) FILTER (is_attack = 0 AND l_quantity <= 30) AS tn FROM v_flow)"""

TESTED = "(SELECT sum(ceil(n * 0.25e0))::BIGINT FROM (SELECT count(*) AS n FROM v_flow GROUP BY is_attack))"

ORACLE = {
    "flow_random_forest": flow(f"SELECT {TESTED} AS n, true AS valid"),
    "flow_random_forest_planted": flow(f"SELECT {TESTED} AS n, true AS found, true AS clean"),
    "flow_predict_properties": flow("SELECT count(*) AS n, true AS in_range, true AS agree FROM v_flow"),
    "flow_feature_importance_sum": "SELECT 5 AS n, 1e0 AS whole, true AS positive",
    "flow_model_store_same": flow("SELECT count(*) AS n, true AS same FROM v_flow"),
    "flow_label_map": flow(f"SELECT {LABEL} AS Label, {KIND} AS Attack_Type, CAST({KIND} <> 'Normal' AS BIGINT) AS is_attack, count(*) AS n FROM v_flow GROUP BY ALL"),
    "flow_class_distribution": flow(f"""
        SELECT {KIND} AS Attack_Type, count(*) AS n, (SELECT round(count(*) FILTER ({KIND} <> 'Normal') * 1e0 / count(*) * 100, 6) FROM v_flow) AS attack_share
        FROM v_flow GROUP BY 1"""),
    "flow_stratified_split": flow("""
        , c AS (SELECT is_attack, count(*) AS n FROM v_flow GROUP BY is_attack)
        SELECT CAST(is_attack AS BIGINT) AS is_attack, true AS is_test, CAST(ceil(n * 0.25e0) AS BIGINT) AS n FROM c
        UNION ALL SELECT CAST(is_attack AS BIGINT), false, n - CAST(ceil(n * 0.25e0) AS BIGINT) FROM c"""),
    "flow_standardize": flow(", s AS (SELECT " + ", ".join(
        f"avg({c}) AS m_{c}, stddev_pop({c}) AS d_{c}" for c in FEATURES) + " FROM v_flow WHERE l_discount < 0.05e0) SELECT " + ", ".join(
        f"round(({c} - m_{c}) / d_{c}, 6) AS {c}" for c in FEATURES) + " FROM v_flow, s"),
    "flow_evaluate": flow(f""", {CELLS}
        SELECT tp, fp, fn, tn, round((tp + tn) * 1e0 / (tp + fp + fn + tn) * 100, 6) AS accuracy, round(tp * 1e0 / (tp + fp) * 100, 6) AS precision,
          round(tp * 1e0 / (tp + fn) * 100, 6) AS recall, round(tp * 2e0 / (tp * 2 + fp + fn) * 100, 6) AS f1 FROM c"""),
    "flow_class_report": flow(f""", {CELLS},
        r AS (SELECT 'Attack' AS class, tp * 1e2 / (tp + fp) AS p, tp * 1e2 / (tp + fn) AS r, tp * 2e2 / (tp * 2 + fp + fn) AS f, tp + fn AS n FROM c
          UNION ALL SELECT 'Normal', tn * 1e2 / (tn + fn), tn * 1e2 / (tn + fp), tn * 2e2 / (tn * 2 + fp + fn), tn + fp FROM c),
        a AS (SELECT * FROM r UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(n) FROM r
          UNION ALL SELECT 'weighted avg', sum(p * n) / sum(n), sum(r * n) / sum(n), sum(f * n) / sum(n), sum(n) FROM r)
        SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, n::BIGINT AS support FROM a"""),
    "flow_combine": flow("""
        , p AS (SELECT l_quantity, l_linenumber, l_quantity / 50e0 AS p, least(10e0, round(l_quantity / 50e0 * 10, 2)) AS risk FROM v_flow)
        SELECT l_quantity, l_linenumber, p > 0.5e0 OR (p > 0.4e0 AND l_linenumber > 4) AS is_attack_predicted, risk,
          CASE WHEN risk >= 7 THEN 'HIGH' WHEN risk >= 4 THEN 'MEDIUM' ELSE 'LOW' END AS confidence, count(*) AS n FROM p GROUP BY ALL"""),
}

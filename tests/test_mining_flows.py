import itertools
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from logwarden.operators import alerts, correlate, enrich, flows, iforest, mining


def transactions(spark, sets):
    return spark.createDataFrame([(s,) for s in sets], "items array<string>")


def brute(sets, support):
    items = sorted({x for s in sets for x in s})
    found = {}
    for k in range(1, len(items) + 1):
        for c in itertools.combinations(items, k):
            n = sum(set(c) <= set(s) for s in sets)
            if n and n / len(sets) >= support:
                found[c] = n
    return found


def test_small_rules(spark):
    itemsets = mining.rules_itemsets(transactions(spark, [list("abc"), list("abc"), ["a"]]), 0.5)
    assert itemsets.count() == 7
    assert mining.rules_association(itemsets, 0.1, None).count() == 12


def test_itemsets_as_by_listing(spark):
    random.seed(4)
    sets = [random.sample("abcdefg", random.randint(0, 5)) for _ in range(60)] + [["a", "a", "b"]]
    for support in (0.02, 0.1):
        got = {tuple(r["items"]): r["freq"] for r in mining.rules_itemsets(transactions(spark, sets), support).collect()}
        assert got == brute([set(s) for s in sets], support)
    assert mining.rules_itemsets(transactions(spark, sets).limit(0)).count() == 0
    assert mining.rules_association(mining.rules_itemsets(transactions(spark, sets).limit(0))).count() == 0


def test_rules_of_wide_transactions(spark):
    # 40 items in one transaction, of which pairs are frequent: listing subsets would take 2 ** 40
    sets = [[f"i{k:02}" for k in range(40)]] + [[f"i{k:02}", f"i{(k + 1) % 40:02}"] for k in range(40) for _ in range(3)]
    itemsets = mining.rules_itemsets(transactions(spark, sets), 3 / len(sets))
    freq = {tuple(r["items"]): r["freq"] for r in itemsets.collect()}
    assert len(freq) == 80 and freq[("i00",)] == 7 and freq[("i00", "i01")] == 4 and freq[("i00", "i39")] == 4
    found = mining.rules_association(itemsets, 0.5).collect()
    assert len(found) == 80 and all(abs(r["confidence"] - 4 / 7) < 1e-12 for r in found)


def test_rules_as_by_all_splits(spark):
    random.seed(8)
    sets = [random.choices("abcdef", k=random.randint(1, 6)) + ["z"] * (random.random() < 0.7) for _ in range(80)]
    count = brute([set(s) for s in sets], 0.05)
    want = set()
    for items, n in count.items():
        for size in range(1, len(items)):
            for right in itertools.combinations(items, size):
                left = tuple(x for x in items if x not in right)
                if n / count[left] >= 0.15:
                    want.add((left, right, round(n / count[left], 9), round(n / count[left] / (count[right] / len(sets)), 9)))
    itemsets = mining.rules_itemsets(transactions(spark, sets), 0.05)
    got = {(tuple(r["antecedents"]), tuple(r["consequents"]), round(r["confidence"], 9), round(r["lift"], 9)) for r in mining.rules_association(itemsets, 0.15).collect()}
    assert got == want and any(len(w[1]) > 1 for w in want)


def test_exact_quantiles(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=5003), rng.integers(0, 4, 5003).astype(float)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double").repartition(7)
    probabilities = [0.0, 1 / 3, 0.5, 2 / 3, 1.0]
    got = mining.exact_quantiles(df, ["a", "b"], probabilities, accuracy=100)
    assert np.allclose(got["a"], np.quantile(a, probabilities), atol=1e-12)
    assert np.allclose(got["b"], np.quantile(b, probabilities), atol=1e-12)


def test_contains_join_short_and_long_lists_agree(spark):
    random.seed(9)
    texts = spark.createDataFrame([(i, "".join(random.choices("abC.", k=random.randint(0, 12)))) for i in range(200)], "id int, text string")
    parts = spark.createDataFrame([("".join(random.choices("abc.", k=k)),) for k in (1, 2, 3, 4, 5, 6) for _ in range(4)], "part string").distinct()

    def pairs(limit):
        return sorted((r["id"], r["part"]) for r in enrich.contains_join(texts, "text", parts, "part", shard_chars=limit).collect())

    want = sorted((t["id"], p["part"]) for t in texts.collect() for p in parts.collect() if p["part"] in t["text"].lower())
    assert pairs(1 << 24) == pairs(30) == want


def test_many_patterns_with_one_prefix(spark):
    words = [f"www.{i:05}.example" for i in range(5000)]
    parts = spark.createDataFrame([(w, i) for i, w in enumerate(words)] + [("WWW.00007.Example", -1), ("", -2), (None, -3)], "part string, n int")
    texts = spark.createDataFrame([(1, "see www.00007.example and WWW.04999.EXAMPLE"), (2, "www."), (3, None), (4, "")], "id int, text string")
    joined = enrich.contains_join(texts, "text", parts, "part")
    assert sorted((r["id"], r["n"]) for r in joined.collect()) == [(1, -1), (1, 7), (1, 4999)]
    assert "NestedLoop" not in joined._jdf.queryExecution().toString()
    assert enrich.contains_join(texts, "text", parts.limit(0), "part").count() == 0


def test_many_score_rules(spark):
    random.seed(3)
    scores = [random.choice([random.uniform(0, 10), round(random.uniform(0, 10), 1), 7.0, None]) for _ in range(2000)] + [-3.0, 12.5, float("nan")]
    threats = spark.createDataFrame([("t", x, datetime(2024, 1, 1) + timedelta(seconds=i)) for i, x in enumerate(scores)], "threat_type string, risk_score double, timestamp timestamp")
    asked = [random.choice([random.uniform(-5, 15), round(random.uniform(0, 10), 1), 7.0]) for _ in range(10_000)]
    table = spark.createDataFrame([(f"r{i}", "risk_threshold", "HIGH", True, '{"min_risk_score": %r}' % a) for i, a in enumerate(asked)],
                                  "name string, rule_type string, severity_threshold string, is_active boolean, conditions string")
    found = alerts.alert_rules_eval(threats, table)
    assert "NestedLoop" not in found._jdf.queryExecution().toString()
    got = {r["name"]: (r["matches"], r["last_match"]) for r in found.collect()}
    known = np.array([x for x in scores if x is not None])
    places = [i for i, x in enumerate(scores) if x is not None]
    for i, a in enumerate(asked):
        hit = (known >= a) | np.isnan(known)
        assert got[f"r{i}"] == (hit.sum(), datetime(2024, 1, 1) + timedelta(seconds=max(p for p, h in zip(places, hit) if h)))


def test_split_shares_are_exact_and_repeatable(spark):
    # one class holds nearly everything
    df = spark.range(4001).select(F.concat(F.lit("f"), "id").alias("flow_id"), (F.col("id") < 7).cast("int").alias("is_attack"))
    once = flows.flow_stratified_split(df)
    counts = {(r["is_attack"], r["is_test"]): r["count"] for r in once.groupBy("is_attack", "is_test").count().collect()}
    assert counts == {(0, True): 999, (0, False): 2995, (1, True): 2, (1, False): 5}
    again = flows.flow_stratified_split(df.repartition(5))
    assert once.join(again, ["flow_id", "is_test"]).count() == 4001


def test_isolation_forest_finds_outliers_and_is_repeatable(spark):
    rng = np.random.default_rng(1)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(600, 2)))] + [(1000 + i, 9.0 + i, -9.0) for i in range(6)]
    df = spark.createDataFrame(rows, "id bigint, x double, y double")
    forest = iforest.fit(df, ["x", "y"], trees=40, contamination=0.02, id_column="id")
    assert len(forest.trees) == 40 and forest.sample == iforest.SAMPLE
    top = [r["id"] for r in iforest.predict(df, forest).orderBy(F.desc("anomaly_score")).limit(6).collect()]
    assert set(top) == {1000 + i for i in range(6)}
    again = iforest.fit(df.repartition(9), ["x", "y"], trees=40, contamination=0.02, id_column="id")
    assert again.trees == forest.trees
    assert iforest.IsolationForest.from_json(forest.to_json()).trees == forest.trees


def test_class_of_a_text(spark):
    df = spark.createDataFrame([("SQL injection test", "sql_injection")], "description string, threat_type string")
    row = correlate.classify_threat_text(df).first()
    assert (row["class"], row["match_score"]) == ("sql_injection", 2)
    assert abs(row["class_confidence"] - 0.92 * 2 / 6) < 1e-12


def test_flow_evaluation_without_positives(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.0)], "is_attack int, prediction double")
    row = flows.flow_evaluate(df).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (100.0, 0.0, 0.0, 0.0)


def test_queries_grow_whole_forests(spark, monkeypatch):
    from checks import q_flows, q_streaming

    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(f"f{i}", float(x), float(y), int(x * y > 0)) for i, (x, y) in enumerate(rng.normal(size=(40, 2)))], "flow_id string, x double, y double, is_attack int")
    monkeypatch.setattr(q_flows, "train", lambda s, d: df)
    monkeypatch.setattr(q_flows, "FEATURES", ["x", "y"])
    model = q_flows.forest(spark, "")
    assert (len(model.trees), model.depth, model.sampled) == (200, None, 40)
    assert flows.flow_random_forest(df, ["x", "y"], trees=2).depth is None
    asked = {}
    monkeypatch.setattr(q_streaming.iforest, "fit", lambda rows, features, trees=100, **kw: asked.update(trees=trees))
    monkeypatch.setattr(q_streaming, "entry_features", lambda logs: df.selectExpr("flow_id AS id", *[f"x AS `{f}`" for f in q_streaming.ENTRY_FEATURES]))
    monkeypatch.setattr(q_streaming.v, "v_log", lambda s, d: None)
    q_streaming.forest_and_scale(spark, "")
    assert asked == {"trees": 100}

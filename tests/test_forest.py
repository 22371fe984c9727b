"""Random forests against plain recursion, planted rules and odd tables."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from logwarden.operators import descent, flows, forest, iforest


def gini(labels, weight):
    total = weight.sum()
    share = (weight * labels).sum() / total
    return total * (1 - share**2 - (1 - share) ** 2)


def paths(x, y, w, depth):
    """Share of label 1 in the leaf of each row, by trying every split of every feature in plain recursion."""
    out = np.empty(len(y))

    def go(rows, level):
        best = None
        if 0 < y[rows].sum() < len(rows) and (depth is None or level < depth):
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[:-1]:
                    left = x[rows, f] <= cut
                    after = gini(y[rows][left], w[rows][left]) + gini(y[rows][~left], w[rows][~left])
                    if best is None or after < best[0] - 1e-9:
                        best = (after, left)
        if best is None:
            out[rows] = (w[rows] * y[rows]).sum() / w[rows].sum()
            return
        go(rows[best[1]], level + 1)
        go(rows[~best[1]], level + 1)

    go(np.arange(len(y)), 0)
    return out


def follow(tree, x):
    out = []
    for row in x:
        node = 0
        while tree["feature"][node] >= 0:
            node = tree["child"][node] + (row[tree["feature"][node]] > tree["value"][node])
        out.append(tree["value"][node])
    return np.array(out)


class WholeBootstrap:
    """Draws every row once and features in their order, so that a tree is determined."""

    def integers(self, low, high, n):
        return np.arange(n)

    def random(self, shape):
        return np.tile(np.linspace(0, 0.9, shape[1]), (shape[0], 1))


@pytest.mark.parametrize("depth", [None, 0, 1, 3])
def test_tree_as_by_recursion(depth):
    rng = np.random.default_rng(5)
    for turn in range(6):
        x = rng.normal(size=(120, 3))
        y = (rng.random(120) < 0.5 * (x[:, 0] > 0) + 0.3).astype(np.int8)
        w = np.where(y == 1, 2.0, 0.7)
        tree = forest.grow(*forest.ranked(x), y, w, 3, depth, WholeBootstrap())
        got, want = follow(tree, x), paths(x, y, w, depth)
        assert depth is not None or set(got) == {0.0, 1.0}
        # equal gains may be split in another order, which changes leaves of deep trees only
        assert np.allclose(got, want) or depth == 3 and np.mean(np.isclose(got, want)) > 0.9
        assert tree["importance"].sum() == pytest.approx(1 if depth != 0 else 0)


def test_repeated_values_and_rows():
    x = np.array([[1.0, 5.0], [1.0, 5.0], [1.0, 5.0], [2.0, 5.0], [2.0, 5.0]])
    y = np.array([0, 1, 1, 0, 0], dtype=np.int8)
    tree = forest.grow(*forest.ranked(x), y, np.ones(5), 1, None, WholeBootstrap())
    assert follow(tree, x).tolist() == pytest.approx([2 / 3] * 3 + [0, 0])
    # neighbouring doubles have no number between them
    near = np.array([[1.0], [np.nextafter(1.0, 2)]])
    tree = forest.grow(*forest.ranked(near), np.array([0, 1], dtype=np.int8), np.ones(2), 1, None, WholeBootstrap())
    assert follow(tree, near).tolist() == [0.0, 1.0]


def flow_rows(spark, n=3000):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(n, 4))
    rows = [(f"f{i}", *map(float, v), int(v[0] > 1.2 and v[1] > 0)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "flow_id string, a double, b double, c double, d double, is_attack int")


def test_forest_learns_a_rare_class_and_survives_storage(spark, tmp_path):
    rows = flows.flow_stratified_split(flow_rows(spark))
    model = flows.flow_random_forest(rows.where("NOT is_test"), list("abcd"), trees=40)
    judged = model.transform(rows.where("is_test"))
    score = flows.flow_evaluate(judged).first()
    assert score["recall"] > 90 and score["precision"] > 90
    top = [r["feature"] for r in flows.flow_feature_importance(spark, model, 2).collect()]
    assert sorted(top) == ["a", "b"] and sum(model.importances) == pytest.approx(1)
    again = flows.flow_random_forest(rows.where("NOT is_test").repartition(7), list("abcd"), trees=40)
    assert all((a["value"] == b["value"]).all() for a, b in zip(model.trees, again.trees))
    odd = flows.flow_iforest_fit(rows, list("abcd"), trees=10)
    flows.flow_model_save(spark, str(tmp_path / "m"), model, odd, {"a": (0.0, 1.0)})
    loaded, anomalies, scale = flows.flow_model_load(spark, str(tmp_path / "m"))
    assert scale == {"a": (0.0, 1.0)} and anomalies.trees == odd.trees and loaded.features == list("abcd")
    both = flows.flow_predict(rows, model, odd).select("flow_id", "p", "risk").exceptAll(flows.flow_predict(rows, loaded, anomalies).select("flow_id", "p", "risk"))
    assert both.count() == 0


def test_sample_is_bounded_and_keeps_the_rare_class(spark):
    rows = flow_rows(spark).withColumn("is_attack", (F.substring("flow_id", 2, 9).cast("int") < 30).cast("int"))
    x, y = forest.labelled_sample(rows, list("abcd"), "is_attack", 500, 1, "flow_id")
    assert len(y) == 500 and y.sum() == 30
    again, _ = forest.labelled_sample(rows.repartition(9), list("abcd"), "is_attack", 500, 1, "flow_id")
    assert (x == again).all()
    whole, _ = forest.labelled_sample(rows, list("abcd"), "is_attack", 5000, 1, None)
    assert len(whole) == 3000


def test_odd_tables(spark):
    rows = flow_rows(spark, 60)
    none = flows.flow_random_forest(rows.limit(0), list("abcd"), trees=3)
    assert none.trees == [] and flows.flow_predict(rows, none).agg(F.max("p")).first()[0] == 0.0
    one = flows.flow_random_forest(rows.withColumn("is_attack", F.lit(1)), list("abcd"), trees=3)
    assert flows.flow_predict(rows.drop("c"), one).agg(F.min("p")).first()[0] == 1.0 and sum(one.importances) == 0
    holes = rows.withColumn("a", F.when(F.col("a") > 0, F.lit(float("nan")))).withColumn("b", F.when(F.col("b") > 0, F.col("b")))
    holes = holes.withColumn("is_attack", F.when(F.col("c") > -1, F.col("is_attack")))
    model = flows.flow_random_forest(holes, list("abcd"), trees=3)
    assert 0 < model.sampled < 60 and flows.flow_predict(holes, model).where("p IS NULL").count() == 0


def test_words_lead_to_the_same_leaves():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(500, 3)), 1)
    y = (rng.random(500) < 0.4).astype(np.int8)
    trees = [forest.grow(*forest.ranked(x), y, np.ones(500), 1, depth, np.random.default_rng(i)) for i, depth in enumerate([None, None, 2, 0])]
    rows = np.vstack((x[:200], rng.normal(size=(200, 3)), [[np.inf, -np.inf, 0.0], [-0.0, 9e99, -9e99]]))
    want = sum(follow(t, rows) for t in trees)
    assert (descent.Trees([(t["feature"], t["value"], t["child"]) for t in trees], 3).total(rows) == want).all()
    assert descent.Trees([], 3).total(rows).tolist() == [0.0] * len(rows)
    # isolation trees: not a number goes to the right
    rows[::7, 1] = np.nan
    grown = [iforest.grow(x[i : i + 100], np.random.default_rng(i)) for i in range(5)]
    want = np.zeros(len(rows))
    for t in grown:
        for i, row in enumerate(rows):
            node = 0
            while t["feature"][node] >= 0:
                node = t["left"][node] if row[t["feature"][node]] <= t["threshold"][node] else t["right"][node]
            want[i] += t["depth"][node]
    assert (descent.Trees([iforest.paired(t) for t in grown], 3).total(rows) == want).all()


def test_equal_rows_are_scored_once(spark):
    seen = []
    batches = [pd.DataFrame({"a": [1.0, 1.0, 2.0]}), pd.DataFrame({"a": [2.0]}), pd.DataFrame({"a": []}), pd.DataFrame({"a": [3.0, 1.0]})]
    got = list(descent.by_blocks(iter(batches), lambda x: seen.append(len(x)) or x[:, 0] * 10))
    assert [list(s) for s in got] == [[10, 10, 20], [20], [], [30, 10]] and seen == [4]
    rows = flow_rows(spark, 200)
    many = rows.unionByName(rows).unionByName(rows.withColumn("flow_id", F.concat("flow_id", F.lit("x")))).withColumn("b", F.when(F.col("b") > 0, F.col("b")))
    model, odd = flows.flow_random_forest(rows, list("abcd"), trees=5), flows.flow_iforest_fit(rows, list("abcd"), trees=5)
    judged = flows.flow_predict(many, model, odd)
    plain = model.transform(many.fillna(0.0, list("abcd")))
    assert judged.columns[: len(many.columns)] == many.columns
    assert judged.select("flow_id", "p").exceptAll(plain.select("flow_id", "p")).count() == 0 and judged.count() == 600
    # equal flows meet also where only totals are asked for
    plan = judged.agg(F.count("*"), F.max("risk"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [" in plan and "RebalancePartitions" in plan

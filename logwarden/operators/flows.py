"""Labelled network flows: labels, split, scaling, models and their evaluation."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logwarden import rules
from logwarden.common import ladder, operator
from logwarden.operators import forest as random_forest
from logwarden.operators import iforest
from logwarden.operators.forest import RandomForest


@operator
def flow_label_map(flows: DataFrame, label: str = "Label", labels: dict[str, str] | None = None) -> DataFrame:
    """Attack_Type and is_attack of a published label; unknown labels count as attacks."""
    table = rules.flow_label_map() if labels is None else labels
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    kind = F.coalesce(F.element_at(F.create_map(*pairs), F.col(label)), F.lit("Unknown"))
    return flows.withColumn("Attack_Type", kind).withColumn("is_attack", (F.col("Attack_Type") != "Normal").cast("int"))


@operator
def flow_class_distribution(flows: DataFrame) -> DataFrame:
    """Rows per attack type and the share of attacks over all types, in percent."""
    per_type = flows.groupBy("Attack_Type").agg(F.count("*").alias("n"), F.max("is_attack").alias("is_attack"))
    share = per_type.agg(F.sum(F.col("n") * F.col("is_attack")) / F.sum("n") * 100).scalar()
    return per_type.select("Attack_Type", "n", share.alias("attack_share"))


SPLIT_BUCKETS = 1 << 16


@operator
def flow_stratified_split(
    flows: DataFrame, label: str = "is_attack", test_share: float = 0.25, seed: int = 42, id_column: str = "flow_id"
) -> DataFrame:
    """Adds ``is_test``: exactly ceil(share x n) rows of each class, by hash of the id.

    Ranking all rows of a class would sort a class in one task.  Rows are counted per (class, hash
    bucket) instead; whole buckets go to one side, and only the rows of the one bucket in which the
    boundary falls are ranked.
    """
    hashed = flows.withColumn("_h", F.xxhash64(F.col(id_column), F.lit(seed)))
    hashed = hashed.withColumn("_bucket", F.pmod(F.col("_h"), F.lit(SPLIT_BUCKETS)))
    counts = hashed.groupBy(label, "_bucket").agg(F.count("*").alias("n"))
    running = Window.partitionBy(label).orderBy("_bucket")
    totals = counts.groupBy(label).agg(F.ceil(F.sum("n") * test_share).alias("_wanted"))
    cut = (
        counts.withColumn("_upto", F.sum("n").over(running))
        .join(totals, label)
        .where((F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("n") < F.col("_wanted")))
        .select(label, F.col("_bucket").alias("_cut"), (F.col("_wanted") - F.col("_upto") + F.col("n")).alias("_need"))
    )
    marked = hashed.join(F.broadcast(cut), label)  # one row per class
    at_cut = F.col("_bucket") == F.col("_cut")
    rank = F.row_number().over(Window.partitionBy(label).orderBy("_h", id_column))
    columns = flows.columns
    whole = marked.where(~at_cut).select(*columns, (F.col("_bucket") < F.col("_cut")).alias("is_test"))
    boundary = marked.where(at_cut).withColumn("_rank", rank).select(*columns, (F.col("_rank") <= F.col("_need")).alias("is_test"))
    return whole.unionByName(boundary)


def fit_standardize(flows: DataFrame, features: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per feature: one aggregate, one row."""
    stats = flows.agg(
        *[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(features)],
        *[F.stddev_pop(f"`{c}`").alias(f"s{i}") for i, c in enumerate(features)],
    ).first()
    return {c: (stats[f"m{i}"] or 0.0, stats[f"s{i}"] or 0.0) for i, c in enumerate(features)}


@operator
def flow_standardize(flows: DataFrame, scale: dict[str, tuple[float, float]], suffix: str = "") -> DataFrame:
    """(x - mean) / deviation; a feature without variance becomes 0."""
    return flows.withColumns(
        {
            f"{c}{suffix}": F.lit(0.0) if dev == 0 else (F.col(f"`{c}`") - F.lit(mean)) / F.lit(dev)
            for c, (mean, dev) in scale.items()
        }
    )


def flow_random_forest(
    flows: DataFrame, features: list[str], label: str = "is_attack", trees: int = 200, depth: int | None = None, seed: int = 42,
    sample: int = random_forest.SAMPLE, id_column: str | None = "flow_id",
) -> RandomForest:
    """Balanced random forest on at most ``sample`` labelled rows; trees grow until their leaves are pure.

    Splits depend on the order of a feature's values only, so features are not scaled first.
    """
    return random_forest.fit(flows, features, label, trees, depth, seed, sample, id_column if id_column in flows.columns else None)


def flow_iforest_fit(
    flows: DataFrame, features: list[str], label: str | None = "is_attack", trees: int = 100, contamination: float = 0.02, seed: int = 42,
    id_column: str | None = "flow_id",
) -> iforest.IsolationForest:
    """Isolation forest on the normal rows only."""
    normal = flows if label is None else flows.where(F.col(label) == 0)
    return iforest.fit(normal, features, trees, contamination, seed, id_column)


@operator
def flow_iforest_score(flows: DataFrame, forest: iforest.IsolationForest) -> DataFrame:
    return iforest.predict(flows, forest)


@operator
def flow_evaluate(predictions: DataFrame, label: str = "is_attack", predicted: str = "prediction") -> DataFrame:
    """Confusion matrix and accuracy, precision, recall and F1 in percent, in one row."""
    truth, guess = F.col(label) == 1, F.col(predicted) == 1
    cells = predictions.agg(
        F.count_if(truth & guess).alias("tp"), F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"), F.count_if(~truth & ~guess).alias("tn"),
    )
    return cells.withColumns(_rates(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole * 100).otherwise(F.lit(0.0))


def _rates(tp, fp, fn, tn) -> dict[str, Column]:
    return {
        "accuracy": _share(tp + tn, tp + fp + fn + tn),
        "precision": _share(tp, tp + fp),
        "recall": _share(tp, tp + fn),
        "f1": _share(tp * 2, tp * 2 + fp + fn),
    }


@operator
def flow_class_report(predictions: DataFrame, label: str = "is_attack", predicted: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and rows per class, then their mean over the classes and their mean weighted by rows."""
    cells = flow_evaluate(predictions, label, predicted)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def line(name: str, hit, wrong, missed) -> Column:
        return F.struct(
            F.lit(name).alias("class"), _share(hit, hit + wrong).alias("precision"), _share(hit, hit + missed).alias("recall"),
            _share(hit * 2, hit * 2 + wrong + missed).alias("f1"), (hit + missed).alias("support"),
        )

    normal, attack = line("Normal", tn, fn, fp), line("Attack", tp, fp, fn)
    total = normal["support"] + attack["support"]

    def mean(name: str, left: Column, right: Column) -> Column:
        scores = [F.coalesce((normal[c] * left + attack[c] * right) / F.nullif(left + right, F.lit(0)), F.lit(0.0)).alias(c)
                  for c in ("precision", "recall", "f1")]
        return F.struct(F.lit(name).alias("class"), *scores, total.alias("support"))

    one = F.lit(1)
    return cells.select(F.inline(F.array(
        normal, attack, mean("macro avg", one, one), mean("weighted avg", normal["support"], attack["support"]))))


def flow_feature_importance(spark: SparkSession, model: RandomForest, k: int | None = 5) -> DataFrame:
    """The ``k`` features that lower the impurity most, or all, with their shares; all shares sum to 1."""
    rows = sorted(zip(model.features, model.importances), key=lambda r: (-r[1], r[0]))[:k]
    return spark.createDataFrame(rows, "feature string, importance double")


@operator
def flow_combine(scored: DataFrame, probability: str = "p", forest_flag: str = "is_anomaly") -> DataFrame:
    """Attack if the forest of trees says so (p > 0.5), or p > 0.4 and the isolation forest agrees."""
    p = F.col(probability)
    risk = F.bround(F.least(F.lit(10.0), p * 10.0), 2)
    return scored.withColumns(
        {
            "is_attack_predicted": (p > 0.5) | ((p > 0.4) & F.coalesce(F.col(forest_flag), F.lit(False))),
            "risk": risk,
            "confidence": ladder(risk, [(7.0, "HIGH"), (4.0, "MEDIUM"), (None, "LOW")]),
        }
    )


def _equal_together(flows: DataFrame, features: list[str]) -> DataFrame:
    """The flows with equal ones next to each other, of which a model scores the first only.

    Adaptive execution splits what a frequent flow makes too large.  A stream stays as it is.
    """
    if flows.isStreaming or not features:
        return flows
    keys = [F.col(f"`{f}`") for f in features]
    together = flows.hint("rebalance", *keys).sortWithinPartitions(*keys)
    # the optimizer would leave out an order that no aggregate above asks for, but not below a generator
    return together.select("*", F.inline(F.array(F.struct(F.lit(0).alias("_together"))))).drop("_together")


@operator
def flow_predict(flows: DataFrame, model: RandomForest, anomalies: iforest.IsolationForest | None = None) -> DataFrame:
    """Probability, combined verdict, risk and confidence per flow; missing features count as 0."""
    names = {*model.features, *(anomalies.features if anomalies else [])}
    filled = flows.withColumns({f: F.coalesce(F.col(f"`{f}`"), F.lit(0.0)) if f in flows.columns else F.lit(0.0) for f in sorted(names)})
    scored = model.transform(_equal_together(filled, sorted(names)))
    scored = iforest.predict(scored, anomalies) if anomalies else scored.withColumn("is_anomaly", F.lit(False))
    return flow_combine(scored)


def flow_model_save(
    spark: SparkSession, path: str, model: RandomForest, anomalies: iforest.IsolationForest, scale: dict[str, tuple[float, float]] | None = None,
    metrics: DataFrame | None = None,
) -> None:
    """Both forests, the scale of the features and metrics under one folder."""
    model.save(spark, f"{path}/forest")
    meta = [(json.dumps(scale), anomalies.to_json())]
    spark.createDataFrame(meta, "scale string, anomalies string").coalesce(1).write.mode("overwrite").parquet(f"{path}/meta")
    if metrics is not None:
        metrics.write.mode("overwrite").parquet(f"{path}/metrics")


def flow_model_load(spark: SparkSession, path: str) -> tuple[RandomForest, iforest.IsolationForest, dict[str, tuple[float, float]] | None]:
    meta = spark.read.parquet(f"{path}/meta").first()
    scale = json.loads(meta["scale"])
    return (RandomForest.load(spark, f"{path}/forest"), iforest.IsolationForest.from_json(meta["anomalies"]),
            {k: tuple(v) for k, v in scale.items()} if scale else None)

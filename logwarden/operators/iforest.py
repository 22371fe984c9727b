"""Isolation forest (Liu, Ting, Zhou 2008) as Spark jobs.

Fitting: a bounded sample per tree is picked by hash in one pass, and each tree is built in its own
task.  Scoring: the trees, a few hundred kilobytes, go to every task and rows are scored in batches.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logwarden.common import first_per_key
from logwarden.operators.descent import Trees, by_blocks

SAMPLE = 256
EULER = 0.5772156649015329


def mean_path(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


def grow(points: np.ndarray, rng: np.random.Generator) -> dict[str, list]:
    """One tree as arrays: feature (-1 in leaves), threshold, left, right, and path length at leaves."""
    limit = math.ceil(math.log2(max(len(points), 2)))
    tree: dict[str, list] = {"feature": [], "threshold": [], "left": [], "right": [], "depth": []}

    def add(rows: np.ndarray, depth: int) -> int:
        node = len(tree["feature"])
        for name, value in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("depth", depth + mean_path(len(rows)))):
            tree[name].append(value)
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (np.zeros(0), np.zeros(0))
        spread = np.flatnonzero(high > low)
        if depth < limit and len(rows) > 1 and len(spread):
            feature = int(rng.choice(spread))
            threshold = float(rng.uniform(low[feature], high[feature]))
            goes_left = rows[:, feature] <= threshold
            tree["feature"][node], tree["threshold"][node] = feature, threshold
            tree["left"][node] = add(rows[goes_left], depth + 1)
            tree["right"][node] = add(rows[~goes_left], depth + 1)
        return node

    add(points, 0)
    return tree


def paired(tree: dict[str, list]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tree with its nodes numbered anew, level by level, so that the two children of a node stand together."""
    feature, left, right = (np.array(tree[k], dtype=np.int64) for k in ("feature", "left", "right"))
    levels = [np.zeros(1, dtype=np.int64)]
    while len(inner := levels[-1][feature[levels[-1]] >= 0]):
        levels.append(np.stack((left[inner], right[inner]), axis=1).ravel())
    order = np.concatenate(levels)
    place = np.argsort(order)
    inner = feature[order] >= 0
    value = np.where(inner, np.array(tree["threshold"])[order], np.array(tree["depth"])[order])
    return feature[order], value, np.where(inner, place[left[order]], 0)


@dataclass
class IsolationForest:
    features: list[str]
    trees: list[dict[str, list]]
    sample: int
    cut: float = 0.5  # rows that score above it are anomalies

    def score(self) -> Column:
        """Anomaly score in (0, 1) of the feature columns; higher is more anomalous."""
        trees = Trees([paired(t) for t in self.trees], len(self.features))
        scale = mean_path(self.sample) or 1.0

        @F.pandas_udf("double")
        def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            return by_blocks(batches, lambda x: np.power(2.0, -trees.total(x) / len(trees.trees) / scale))

        return scored(F.struct(*[F.col(f"`{f}`").cast("double") for f in self.features]))

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @staticmethod
    def from_json(text: str) -> "IsolationForest":
        return IsolationForest(**json.loads(text))


def fit(
    rows: DataFrame, features: list[str], trees: int = 100, contamination: float = 0.1, seed: int = 42, id_column: str | None = None
) -> IsolationForest:
    """Forest on ``rows``; ``id_column`` makes the sample repeatable whatever the partitioning."""
    draw = F.xxhash64(F.col(id_column), F.lit(seed)) if id_column else F.xxhash64(F.rand(seed))
    # uniform pool of twice what all trees need, dealt to the trees by hash; a small table is dealt
    # several times.  Both are bounded by trees x SAMPLE, whatever the size of the input.
    size = 2 * trees * SAMPLE
    pool = rows.select(*[F.col(f"`{f}`").cast("double").alias(f"f{i}") for i, f in enumerate(features)], draw.alias("_draw"))
    pool = pool.orderBy("_draw").limit(size)
    available = max(1, rows.limit(size).count())
    copies = min(trees, math.ceil(size / available))
    first = F.pmod(F.xxhash64("_draw"), F.lit(trees))
    dealt = pool.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        "*", ((first + F.col("_copy")) % trees).cast("int").alias("tree"), F.xxhash64("_draw", "_copy").alias("_order")
    )
    samples = first_per_key(dealt, ["tree"], [F.asc("_order"), F.asc("_draw")], SAMPLE)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_order", "_draw"])
        number = int(pdf["tree"].iloc[0])
        points = pdf[[f"f{i}" for i in range(len(features))]].to_numpy(dtype=float)
        tree = grow(points, np.random.default_rng([seed, number]))
        return pd.DataFrame({"tree": [number], "size": [len(points)], "body": [json.dumps(tree)]})

    built = samples.groupBy("tree").applyInPandas(build, "tree int, size int, body string").orderBy("tree").collect()
    forest = IsolationForest(list(features), [json.loads(r["body"]) for r in built], max((r["size"] for r in built), default=0))
    if built:
        cut = rows.select(forest.score().alias("s")).agg(F.percentile_approx("s", 1.0 - contamination, 10_000)).first()[0]
        forest.cut = float(cut)
    return forest


def predict(rows: DataFrame, forest: IsolationForest, score: str = "anomaly_score", flag: str = "is_anomaly") -> DataFrame:
    return rows.withColumn(score, forest.score()).withColumn(flag, F.col(score) > forest.cut)

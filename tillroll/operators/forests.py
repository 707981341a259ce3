"""Fitted forests as a relation of nodes: importances, predictions and attribution from it.

A saved forest is a table with a row per node. Its size is the model's, trees times two to
the depth, whatever the data. Sums over it are plain aggregations; walks of rows through the
trees carry it to the rows as arrays.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.layout import checkpoint_folder, spread

# A coalition of features is the bits of one number.
_MOST_FEATURES = 62


def forest_nodes(model: Model, spark: SparkSession) -> DataFrame:
    """(tree, node, left, right, feature, threshold, gain, weight, prediction, share) per node.

    The model is saved to a new folder under the session's checkpoint folder and read back. Leaves
    have null children, feature, threshold and gain. ``weight`` is the weighted number of training
    rows of the node; ``share`` is the share of the second class among them, null for a regression.
    """
    path = f"{checkpoint_folder(spark)}/forest-{uuid.uuid4().hex}"
    model.write().save(path)
    node, split = "nodeData.{}".format, "nodeData.split.{}".format
    stats = F.col(node("impurityStats"))
    classes = hasattr(model, "numClasses")
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x) if classes else F.get(stats, F.lit(0))
    inner = F.col(node("leftChild")) >= 0

    def of_inner(name: str) -> Column:
        return F.when(inner, F.col(name))

    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col(node("id")).alias("node"),
        of_inner(node("leftChild")).alias("left"),
        of_inner(node("rightChild")).alias("right"),
        of_inner(split("featureIndex")).alias("feature"),
        F.when(inner, F.get(F.col(split("leftCategoriesOrThreshold")), F.lit(0))).alias("threshold"),
        of_inner(node("gain")).alias("gain"),
        total.alias("weight"),
        F.col(node("prediction")).alias("prediction"),
        (F.get(stats, F.lit(1)) / total if classes else F.lit(None).cast("double")).alias("share"),
    )


def node_importances(nodes: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, importance), largest first: gains weighted by rows, as shares of a tree, then of all.

    A forest without any split gives every feature 0.
    """
    names = F.create_map(*[F.lit(x) for i, f in enumerate(features) for x in (i, f)])
    gains = nodes.filter("feature IS NOT NULL").groupBy("tree", "feature").agg(
        F.sum(F.col("gain") * F.col("weight")).alias("gain")
    )
    trees = gains.groupBy("tree").agg(F.sum("gain").alias("total")).filter("total > 0")
    shares = gains.join(trees, "tree").groupBy("feature").agg(
        F.sum(F.col("gain") / F.col("total")).alias("share")
    )
    whole = shares.agg(F.sum("share")).scalar()
    every = nodes.sparkSession.range(len(features)).select(F.col("id").cast("int").alias("feature"))
    return (
        every.join(shares, "feature", "left")
        .select(
            F.element_at(names, F.col("feature")).alias("feature"),
            F.coalesce(F.col("share") / whole, F.lit(0.0)).alias("importance"),
        )
        .orderBy(F.desc("importance"), "feature")
    )


@dataclass(frozen=True)
class Tree:
    """One tree as arrays; ``left`` is -1 at leaves. Node 0 is the root."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def walk(self, rows: np.ndarray, depth: int | None = None) -> np.ndarray:
        """Value of the leaf of each row; up to the threshold is left. ``depth`` cuts the tree there."""
        at, level = np.zeros(len(rows), np.int64), 0
        while level != depth and (inner := np.flatnonzero(self.left[at] >= 0)).size:
            level += 1
            node = at[inner]
            low = rows[inner, self.feature[node]] <= self.threshold[node]
            at[inner] = np.where(low, self.left[node], self.right[node])
        return self.value[at]

    def leaves(self, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(low, high, used, value) per leaf: the interval of each feature on its path, open below."""
        found = []
        start = (0, np.full(n_features, -np.inf), np.full(n_features, np.inf), np.zeros(n_features, bool))
        stack = [start]
        while stack:
            node, low, high, used = stack.pop()
            if self.left[node] < 0:
                found.append((low, high, used, self.value[node]))
                continue
            feature, cut = self.feature[node], self.threshold[node]
            seen = used.copy()
            seen[feature] = True
            below, above = high.copy(), low.copy()
            below[feature], above[feature] = min(high[feature], cut), max(low[feature], cut)
            stack += [(self.left[node], low, below, seen), (self.right[node], above, high, seen)]
        low, high, used, value = zip(*found, strict=True)
        return np.stack(low), np.stack(high), np.stack(used), np.array(value)


def forest_trees(nodes: DataFrame) -> list[Tree]:
    """The trees of a node relation, whose size is the model's. A classifier's value is its share."""
    rows = nodes.withColumn("value", F.coalesce("share", "prediction")).toPandas()
    trees = []
    for _, own in rows.sort_values(["tree", "node"]).groupby("tree"):
        leaf = own["left"].isna().to_numpy()
        trees.append(
            Tree(
                *[own[c].fillna(-1).to_numpy(np.int64) for c in ("left", "right", "feature")],
                np.where(leaf, 0.0, own["threshold"].to_numpy(np.float64)),
                own["value"].to_numpy(np.float64),
            )
        )
    return trees


def walk_forest(
    rows: DataFrame,
    nodes: DataFrame,
    features: Sequence[str],
    name: str = "score",
    depth: int | None = None,
) -> DataFrame:
    """``rows`` with the mean over the trees: a prediction, or a classifier's probability of class 1.

    Rows are scored where they are. A row with a null feature gets null. With ``depth`` the trees
    are cut there, and the nodes at the cut are leaves.
    """
    trees = forest_trees(nodes)

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        values = np.column_stack([c.to_numpy(np.float64) for c in columns])
        return pd.Series(sum(tree.walk(values, depth) for tree in trees) / len(trees))

    present = F.lit(True)
    for feature in features:
        present = present & F.col(feature).isNotNull()
    found = score(*[F.col(f).cast("double") for f in features])
    return rows.withColumn(name, F.when(present, found))


def _bits(inside: np.ndarray, used: np.ndarray) -> np.ndarray:
    """Per (row, leaf): the features whose condition holds, or that the path does not ask for."""
    place = np.int64(1) << np.arange(inside.shape[2], dtype=np.int64)
    return ((inside | ~used) * place).sum(axis=2)


def tree_shapley(
    tree: Tree, rows: np.ndarray, background: np.ndarray, weight: np.ndarray
) -> np.ndarray:
    """Interventional Shapley values of one tree, (row, feature), over a weighted background.

    A coalition reaches a leaf if every feature on the path is inside the leaf's interval, with the
    row's value if it is in the coalition and with the background's if not. So a leaf matters to
    a pair of rows only if each feature is inside for one of both; features inside for the row alone
    gain, those inside for the background alone lose a share fixed by how many there are of
    either. Pairs are met as patterns of bits: rows alike at a leaf are one.
    """
    n_features = rows.shape[1]
    low, high, used, value = tree.leaves(n_features)
    full = (np.int64(1) << n_features) - 1

    def patterns(points: np.ndarray) -> np.ndarray:
        inside = (points[:, None, :] > low) & (points[:, None, :] <= high)
        return _bits(inside, used)

    most = n_features + 1
    gain = np.zeros((most, most))
    for own in range(1, most):
        for other in range(most):
            if own + other <= n_features:
                gain[own, other] = factorial(own - 1) * factorial(other) / factorial(own + other)
    theirs = patterns(background)
    total = np.zeros((len(rows), n_features))
    for start in range(0, len(rows), 512):
        ours = patterns(rows[start : start + 512])
        for leaf in range(len(value)):
            seen, which = np.unique(ours[:, leaf], return_inverse=True)
            a, b = seen[:, None], theirs[None, :, leaf]
            first, second = a & ~b, b & ~a
            met = ((a | b) == full) & (first != second)
            if not met.any():
                continue
            n_first, n_second = np.bitwise_count(first), np.bitwise_count(second)
            up = np.where(met, gain[n_first, n_second], 0.0) * weight
            down = np.where(met, gain[n_second, n_first], 0.0) * weight
            phi = np.empty((len(seen), n_features))
            for f in range(n_features):
                phi[:, f] = (up * (first >> f & 1) - down * (second >> f & 1)).sum(axis=1)
            total[start : start + 512] += value[leaf] * phi[which]
    return total / weight.sum()


def forest_shapley(
    rows: DataFrame,
    background: DataFrame,
    features: Sequence[str],
    nodes: DataFrame,
    keys: Sequence[str],
) -> DataFrame:
    """Score, base value and contribution of every feature, as ``shapley_values`` gives them.

    Exact for the forest of ``nodes`` by walking its leaves, at a cost that grows with leaves and
    patterns instead of two to the number of features. ``background`` is a relation made by
    ``background_rows``; its bounded rows and the nodes are carried to the rows, which are shuffled
    once to use all cores. Up to 62 features, none of them null.
    """
    features, keys = list(features), list(keys)
    if len(features) > _MOST_FEATURES:
        raise ValueError(f"at most {_MOST_FEATURES} features, not {len(features)}")
    trees = forest_trees(nodes)
    pool = background.select(*[F.col(f).cast("double") for f in features], "weight").toPandas()
    others = pool[features].to_numpy(np.float64)
    weight = pool["weight"].to_numpy(np.float64)
    base = sum(tree.walk(others) for tree in trees) / len(trees) @ weight / weight.sum()

    def explain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame[features].to_numpy(np.float64)
            phi = sum(tree_shapley(tree, values, others, weight) for tree in trees) / len(trees)
            found = frame[keys].assign(
                score=sum(tree.walk(values) for tree in trees) / len(trees), base_value=base
            )
            for j, feature in enumerate(features):
                found[feature] = values[:, j]
            for j, feature in enumerate(features):
                found[f"phi_{feature}"] = phi[:, j]
            yield found

    given = spread(rows, *keys).select(*keys, *[F.col(f).cast("double").alias(f) for f in features])
    kinds = [f"`{k}` {given.schema[k].dataType.simpleString()}" for k in keys]
    numbers = ["score", "base_value", *features, *[f"phi_{f}" for f in features]]
    return given.mapInPandas(explain, ", ".join([*kinds, *[f"`{c}` double" for c in numbers]]))

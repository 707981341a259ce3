"""What each feature contributed to a prediction: exact Shapley values.

A coalition is the set of features that keep the row's own value while the others
take the values of a background row. The worth of a coalition is the mean score over
the background. Shapley values are a fixed weighted sum of those means, so a row is
explained by scoring its (coalition, background row) variants and adding up.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.hashing import position_hash
from tillroll.operators.layout import spread

# Rows of a background unless another number is asked for.
BACKGROUND_ROWS = 100

Scorer = Callable[[DataFrame], DataFrame]


def background_rows(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str],
    size: int = BACKGROUND_ROWS,
    seed: int = 42,
) -> DataFrame:
    """A fixed background drawn from the whole table, with a weight per distinct row.

    The ``size`` rows of smallest hash of their keys: a sample without regard to the order in
    which ids were given out. Rows alike in all features are one row of the background that
    weighs as many.
    """
    place = position_hash(df, keys, seed, "background")
    drawn = df.withColumn("_place", place).orderBy("_place", *keys).limit(size)
    return drawn.groupBy(*features).agg(F.count(F.lit(1)).alias("weight"))


def _weights(n: int, feature: int) -> list[float]:
    """Weight of every coalition (as a bit mask) in the Shapley value of a feature."""
    weights = []
    for mask in range(2**n):
        size = mask.bit_count()
        joined = bool(mask >> feature & 1)
        others = size - 1 if joined else size
        weight = factorial(others) * factorial(n - 1 - others) / factorial(n)
        weights.append(weight if joined else -weight)
    return weights


def _add_weight(total: Column, row: Column) -> Column:
    return total + row["weight"]


def shapley_values(
    rows: DataFrame,
    background: DataFrame,
    features: Sequence[str],
    scorer: Column | Scorer,
    keys: Sequence[str],
    reads: Sequence[str] | None = None,
) -> DataFrame:
    """Score, base value and contribution of every feature, one row per row explained.

    ``scorer`` is an expression over the features, or a function that adds a
    ``score`` column (a fitted model). ``background`` is a relation made by
    :func:`background_rows`; its size is the caller's choice, and it becomes one array.
    A row costs two to the number of features times the distinct background rows.

    ``reads`` names the features that the scorer reads, if not all: only those form coalitions,
    as another one contributes exactly nothing. The scorer does not get to see the others.

    Rows are spread over all cores by key, and the variants of a row are made, scored
    and added up where the row is: the rows are shuffled, the variants never.
    Contributions of a row add up to its score minus the base value.
    """
    features, keys = list(features), list(keys)
    played = [f for f in features if reads is None or f in reads]
    n = len(played)
    own = {f: f"_own{j}" for j, f in enumerate(features)}
    idle = [own[f] for f in features if f not in played]
    others = background.groupBy(*[F.col(f).cast("double").alias(f) for f in played]).agg(
        F.sum("weight").alias("weight")
    )
    pool = others.agg(
        F.collect_list(
            F.struct(*[F.col(f).alias(f"b{j}") for j, f in enumerate(played)], F.col("weight"))
        )
    ).scalar()
    variants = (
        spread(rows, *keys)
        .select(*keys, *[F.col(f).cast("double").alias(o) for f, o in own.items()])
        .withColumn("_pool", pool)
        .withColumn("_total", F.aggregate("_pool", F.lit(0).cast("long"), _add_weight))
        .withColumn("_mask", F.explode(F.sequence(F.lit(0), F.lit(2**n - 1))))
        # The full coalition has no feature from the background: one variant stands for all.
        .withColumn(
            "_other",
            F.explode(
                F.when(F.col("_mask") == 2**n - 1, F.slice("_pool", 1, 1)).otherwise(F.col("_pool"))
            ),
        )
        .select(
            *keys,
            *idle,
            "_mask",
            "_total",
            F.when(F.col("_mask") == 2**n - 1, F.col("_total"))
            .otherwise(F.col("_other.weight"))
            .alias("_weight"),
            *[
                F.when(F.col("_mask").bitwiseAND(F.lit(1 << j)) != 0, F.col(own[f]))
                .otherwise(F.col(f"_other.b{j}"))
                .alias(f)
                for j, f in enumerate(played)
            ],
        )
    )
    if isinstance(scorer, Column):
        scored = variants.withColumn("score", scorer.cast("double"))
    else:
        scored = scorer(variants)
    every_own = F.col("_mask") == 2**n - 1
    none_own = F.col("_mask") == 0

    def contribution(f: str) -> Column:
        if f not in played:
            return F.lit(0.0)
        j = played.index(f)
        weights = F.array(*[F.lit(w) for w in _weights(n, j)])
        weight = F.element_at(weights, F.col("_mask") + 1) * F.col("_weight")
        return F.sum(weight * F.col("score")) / F.max("_total")

    return scored.groupBy(*keys).agg(
        F.avg(F.when(every_own, F.col("score"))).alias("score"),
        (F.sum(F.when(none_own, F.col("score") * F.col("_weight"))) / F.max("_total")).alias(
            "base_value"
        ),
        *[F.max(F.when(every_own, F.col(f if f in played else own[f]))).alias(f) for f in features],
        *[contribution(f).alias(f"phi_{f}") for f in features],
    )


def contributions(explained: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Explanations in long form: one row per row explained and feature."""
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col(f).alias("feature_value"),
            F.col(f"phi_{f}").alias("contribution"),
        )
        for f in features
    ]
    return explained.select(*keys, F.inline(F.array(*entries)))


def top_driver(explained: DataFrame, features: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The feature with the largest contribution either way; the first one of a tie."""
    ranked = [
        F.struct(
            F.abs(F.col(f"phi_{f}")).alias("size"),
            F.lit(-position).alias("earlier"),
            F.lit(f).alias("feature"),
            F.col(f"phi_{f}").alias("contribution"),
        )
        for position, f in enumerate(features)
    ]
    best = F.array_max(F.array(*ranked))
    return explained.select(
        *keys, best["feature"].alias("top_driver"), best["contribution"].alias("contribution")
    )

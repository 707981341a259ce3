"""Samples and splits that survive repartitioning and lost executors.

Whether a row is taken follows from its values and the seed. Spark's own sampling
follows from the place of a row in its partition, so a recomputed partition may
take other rows than the first time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.hashing import below


def sample_rows(
    df: DataFrame, fraction: float = 0.1, seed: int = 42, keys: Sequence[str] | None = None
) -> DataFrame:
    """A share of the rows. Rows alike in all ``keys`` are taken, or left, together."""
    return df.where(below(df, keys or df.columns, seed, "sample", fraction))


def split_rows(
    df: DataFrame,
    weights: Sequence[float] = (0.8, 0.2),
    seed: int = 42,
    keys: Sequence[str] | None = None,
) -> list[DataFrame]:
    """Disjoint parts that together are the whole, sized like the weights."""
    keys = keys or df.columns
    total, edge, parts = sum(weights), 0.0, []
    for i, weight in enumerate(weights):
        low, edge = edge, edge + weight / total
        last = i == len(weights) - 1
        from_low = ~below(df, keys, seed, "split", low) if i else F.lit(True)
        parts.append(df.where(from_low if last else from_low & below(df, keys, seed, "split", edge)))
    return parts


def label_split(
    df: DataFrame,
    train_share: float = 0.8,
    seed: int = 42,
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """The two-way split as a column, ``train`` or ``test``."""
    training = below(df, keys or df.columns, seed, "split", train_share)
    return df.withColumn("part", F.when(training, "train").otherwise("test"))

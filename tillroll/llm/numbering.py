"""Running totals inside large groups without putting a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows that share one window task on average.
_ROWS_PER_BUCKET = 4096


def running_total(
    df: DataFrame, group: str, order: Sequence[str], value: Column, name: str
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the group that come before.

    The order inside a group is by bucket and then by ``order``, where the bucket is a
    hash of the ``order`` columns and there are as many buckets as keep them at a few
    thousand rows. A group of any size is summed bucket by bucket, and one row per bucket
    then meets in the second window. Rows equal in all ``order`` columns are
    interchangeable, so reruns agree. ``group`` must not be null. ``df`` is read
    three times and should be checkpointed.
    """
    buckets = max(1, -(-df.count() // _ROWS_PER_BUCKET))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in order]), F.lit(buckets)).cast("int")
    rows = df.withColumn("__value", value.cast("long")).withColumn("__bucket", spread)
    inside = Window.partitionBy(group, "__bucket").orderBy(*order)
    before = Window.partitionBy(group).orderBy("__bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = (
        rows.groupBy(group, "__bucket")
        .agg(F.sum("__value").alias("__sum"))
        .select(
            group, "__bucket", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base")
        )
    )
    summed = rows.withColumn(
        "__inside",
        F.sum("__value").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
    )
    return (
        summed.join(bases, [group, "__bucket"])
        .withColumn(name, F.col("__base") + F.col("__inside") - F.col("__value"))
        .drop("__value", "__bucket", "__inside", "__base")
    )

"""Quantiles of numeric columns.

With a relative error the answer is Spark's mergeable quantile sketch: one job for
all columns, a bounded summary per task. Without one (``relative_error=0``) the
sketch would keep every value and bring the whole column to the driver, so the
exact answer is found by narrowing instead: count rows per bucket of the value
range, keep the bucket that holds the wanted rank, split it again. Each step is a
scan with a map-side combine; the driver sees one row per bucket.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.layout import reused

# Buckets per narrowing step, and the number of rows an interval may have for its
# values to be counted one by one in the last step.
_BUCKETS = 1024
_COUNT_DIRECTLY = 4096


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    relative_error: float = 0.01,
) -> dict[str, list[float] | None]:
    """Quantile values per column; ``None`` for a column without any value.

    Null and NaN do not take part. The quantile at ``p`` of ``n`` values is the
    smallest value with at least ``p * n`` values at or below it.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    if relative_error > 0:
        found = df.approxQuantile(columns, list(probabilities), relative_error)
        return {c: (values or None) for c, values in zip(columns, found)}
    with reused(df.select(*columns)) as values:
        return _exact(values, columns, probabilities)


@dataclass(frozen=True)
class _Interval:
    """Closed value range of one column, and how many rows lie in it."""

    column: str
    low: float
    high: float
    rows: int


@dataclass
class _Target:
    """One wanted quantile: the interval it lies in and its rank inside."""

    interval: _Interval
    rank: int


def _value(column: str) -> Column:
    number = F.col(column).cast("double")
    return F.when(~F.isnan(number), number)


def _bucket(value: Column, interval: _Interval) -> Column:
    """Bucket number that grows with the value.

    Both ends have a bucket of their own, so every step narrows. Halving before
    subtracting keeps the width finite for any pair of finite ends.
    """
    low, high = interval.low, interval.high
    width = high / 2 - low / 2
    if math.isinf(low) or math.isinf(high) or width == 0.0:
        inner = F.lit(1)
    else:
        share = (value / 2 - F.lit(low / 2)) / F.lit(width)
        inner = F.least(F.floor(share * _BUCKETS), F.lit(_BUCKETS - 1)).cast("int") + 1
    return (
        F.when(value == F.lit(low), 0).when(value == F.lit(high), _BUCKETS + 1).otherwise(inner)
    )


def _exact(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float] | None]:
    whole = _whole_range(df, columns)
    targets = {
        (c, p): _Target(whole[c], max(1, math.ceil(p * whole[c].rows)))
        for c in columns
        for p in probabilities
        if whole[c] is not None
    }
    while True:
        open_ones = [t for t in targets.values() if t.interval.low != t.interval.high]
        if not open_ones:
            break
        intervals = list(dict.fromkeys(t.interval for t in open_ones))
        pieces = _split(df, intervals)
        for target in open_ones:
            for piece in pieces[target.interval]:
                if target.rank <= piece.rows:
                    target.interval = piece
                    break
                target.rank -= piece.rows
    return {
        c: None if whole[c] is None else [targets[c, p].interval.low for p in probabilities]
        for c in columns
    }


def _whole_range(df: DataFrame, columns: Sequence[str]) -> dict[str, _Interval | None]:
    measures = []
    for c in columns:
        measures += [F.count(_value(c)), F.min(_value(c)), F.max(_value(c))]
    row = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures)]).first()
    return {
        c: _Interval(c, row[3 * i + 1], row[3 * i + 2], row[3 * i]) if row[3 * i] else None
        for i, c in enumerate(columns)
    }


def _split(df: DataFrame, intervals: Sequence[_Interval]) -> dict[_Interval, list[_Interval]]:
    """Occupied buckets of every interval, in value order. One job for all of them.

    An interval of few rows is split into its single values at once.
    """
    candidates = []
    for number, interval in enumerate(intervals):
        value = _value(interval.column)
        direct = interval.rows <= _COUNT_DIRECTLY
        bucket = F.lit(0) if direct else _bucket(value, interval)
        candidates.append(
            F.when(
                value.between(F.lit(interval.low), F.lit(interval.high)),
                F.struct(
                    F.lit(number).alias("interval"),
                    bucket.alias("bucket"),
                    (value if direct else F.lit(None).cast("double")).alias("single"),
                    value.alias("value"),
                ),
            )
        )
    counted = (
        df.select(F.explode(F.array(*candidates)).alias("hit"))
        .where(F.col("hit").isNotNull())
        .groupBy("hit.interval", "hit.bucket", "hit.single")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("hit.value").alias("low"),
            F.max("hit.value").alias("high"),
        )
    )
    pieces: dict[_Interval, list[_Interval]] = {i: [] for i in intervals}
    for r in counted.collect():
        parent = intervals[r["interval"]]
        pieces[parent].append(_Interval(parent.column, r["low"], r["high"], r["rows"]))
    return {parent: sorted(found, key=lambda i: i.low) for parent, found in pieces.items()}

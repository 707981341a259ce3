"""Quality of predictions, overall and per group, and gaps between segments.

Everything is one aggregation over the prediction relation, whatever the number of
groups: ``by`` takes the grouping columns, and without them there is one row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

METRICS = ("auc_roc", "precision", "recall", "f1")
# Fixed value: a gap above this between two segments is a concern.
FAIRNESS_THRESHOLD = 0.10


def regression_metrics(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Root mean square error and R² of ``predicted`` against ``actual``."""
    squared = F.pow(F.col("actual") - F.col("predicted"), F.lit(2.0))
    spread = F.nullif(F.var_pop("actual") * F.count("actual"), F.lit(0.0))
    return predictions.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(squared)).alias("rmse"),
        (1 - F.sum(squared) / spread).alias("r2"),
    )


def _counts(predictions: DataFrame, by: Sequence[str], score: str | None) -> DataFrame:
    """Class sizes and hits per group, and the ranking wins the AUC is made of.

    A win is a positive scored above a negative; a tie is half a win. Rows are first
    folded to distinct scores, however many rows share one. Those are ranged and sorted by group
    and score, and every partition is scanned once: it counts its own wins and its class sizes.
    Wins over the partitions before need only those sizes, a row per partition and group.

    A row whose score is null or NaN cannot be ranked: it counts in the class sizes and hits,
    which do not look at scores, but not in the wins or in the pairs they are a share of.
    """
    by = list(by)
    positive, claimed = F.col("label") == 1, F.col("prediction") == 1
    sizes = {
        "pos": F.count_if(positive),
        "neg": F.count_if(F.col("label") == 0),
        "hit": F.count_if(positive & claimed),
        "miss": F.count_if((F.col("label") == 0) & claimed),
    }
    if score is None:
        return predictions.groupBy(*by).agg(*[m.alias(n) for n, m in sizes.items()])

    value = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double"))
    # One text per group, which keeps nulls and types apart.
    options = {"ignoreNullFields": "false"}
    group = F.to_json(F.struct(*by), options) if by else F.lit("")
    per_score = predictions.groupBy(group.alias("_group"), value.alias("_score")).agg(
        *[m.alias(n) for n, m in sizes.items()]
    )
    order = ["_group", "_score"]
    scanned = (
        per_score.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInPandas(
            _scan,
            "_group string, _part int, wins double, _pos long, _neg long,"
            " pos long, neg long, hit long, miss long",
        )
    )
    earlier = (
        Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = scanned.withColumn("_lower", F.coalesce(F.sum("_neg").over(earlier), F.lit(0)))
    total = ranked.groupBy(*["_group"] * bool(by)).agg(
        F.sum(F.col("wins") + F.col("_pos").cast("double") * F.col("_lower")).alias("wins"),
        (F.sum("_pos").cast("double") * F.sum("_neg")).alias("pairs"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sizes],
    )
    if not by:
        return total
    schema = ", ".join(f"`{c}` {predictions.schema[c].dataType.simpleString()}" for c in by)
    return total.withColumn("_by", F.from_json("_group", schema)).select(
        *[F.col("_by")[c].alias(c) for c in by], "wins", "pairs", *sizes
    )


def _scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sums per group of a partition whose rows are sorted by group and score."""
    part, names = TaskContext.get().partitionId(), ["pos", "neg", "hit", "miss"]
    group: str | None = None
    sums: dict[str, float] = {}

    def done() -> pd.DataFrame:
        return pd.DataFrame([{"_group": group, "_part": part, **sums}])

    for frame in frames:
        for found, piece in frame.groupby("_group", sort=False):
            if found != group:
                if group is not None:
                    yield done()
                group, sums = found, dict.fromkeys(["wins", "_pos", "_neg", *names], 0)
            ranked = piece[piece["_score"].notna()]
            lower = sums["_neg"] + ranked["neg"].cumsum() - ranked["neg"]
            sums["wins"] += float((ranked["pos"] * (lower + ranked["neg"] / 2)).sum())
            sums["_pos"] += int(ranked["pos"].sum())
            sums["_neg"] += int(ranked["neg"].sum())
            for name in names:
                sums[name] += int(piece[name].sum())
    if group is not None:
        yield done()


def _auc() -> Column:
    return F.col("wins") / F.nullif(F.col("pairs"), F.lit(0.0))


def auc_roc(
    predictions: DataFrame, by: Sequence[str] = (), score: str = "score"
) -> DataFrame:
    """Area under the ROC curve, ties counted half; null when a class is absent."""
    return _counts(predictions, by, score).select(*by, _auc().alias("auc_roc"))


def classification_metrics(
    predictions: DataFrame,
    by: Sequence[str] = (),
    score: str = "score",
    digits: int = 4,
) -> DataFrame:
    """Class sizes, AUC and class-weighted precision, recall and F1.

    Reads ``label`` and ``prediction`` (0 or 1) and the score. A class never
    predicted has precision and F1 of 0.
    """
    pos, neg, hit, miss = (F.col(n).cast("double") for n in ("pos", "neg", "hit", "miss"))
    n = pos + neg

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(part / F.nullif(whole, F.lit(0.0)), F.lit(0.0))

    def f1(precision: Column, recall: Column) -> Column:
        return share(2 * precision * recall, precision + recall)

    def weighted(of_positive: Column, of_negative: Column) -> Column:
        mean = (pos * of_positive + neg * of_negative) / F.nullif(n, F.lit(0.0))
        return F.round(mean, digits)

    right_neg = neg - miss
    precision = share(hit, hit + miss), share(right_neg, right_neg + pos - hit)
    recall = share(hit, pos), share(right_neg, neg)
    return _counts(predictions, by, score).select(
        *by,
        (F.col("pos") + F.col("neg")).alias("n"),
        F.col("pos").alias("n_churned"),
        F.col("neg").alias("n_active"),
        F.round(_auc(), digits).alias("auc_roc"),
        weighted(*precision).alias("precision"),
        weighted(*recall).alias("recall"),
        weighted(f1(precision[0], recall[0]), f1(precision[1], recall[1])).alias("f1"),
    )


def segment_metrics(predictions: DataFrame, score: str = "score") -> DataFrame:
    """:func:`classification_metrics` of every segment, in one job."""
    return classification_metrics(predictions, ["segment"], score)


def fairness_report(
    per_segment: DataFrame, threshold: float = FAIRNESS_THRESHOLD
) -> DataFrame:
    """Gap of each metric between two segments, the largest gap, and whether it matters.

    Empty unless there are exactly two segments; a metric one of them lacks is left
    out. The input has one row per segment, so everything here is tiny.
    """
    values = per_segment.unpivot("segment", list(METRICS), "metric", "value")
    gaps = (
        values.groupBy("metric")
        .agg(
            F.min("segment").alias("segment_a"),
            F.max("segment").alias("segment_b"),
            F.min_by("value", "segment").alias("value_a"),
            F.max_by("value", "segment").alias("value_b"),
            F.count(F.lit(1)).alias("_segments"),
            F.count("value").alias("_values"),
        )
        .where((F.col("_segments") == 2) & (F.col("_values") == 2))
        .withColumn("difference", F.round(F.abs(F.col("value_a") - F.col("value_b")), 4))
    )
    everything = Window.partitionBy()
    largest = F.max("difference").over(everything)
    return gaps.select(
        "metric",
        "segment_a",
        "value_a",
        "segment_b",
        "value_b",
        "difference",
        largest.alias("max_disparity"),
        (largest > threshold).alias("fairness_concern"),
    )

"""Churn evaluation: fit, score, measure, compare segments, explain; one document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.operators.attribution import BACKGROUND_ROWS, background_rows
from tillroll.operators.customers import CHURN_DAYS, CHURN_FEATURES
from tillroll.operators.evaluation import (
    METRICS,
    classification_metrics,
    fairness_report,
    segment_metrics,
)
from tillroll.operators.forests import forest_nodes, forest_shapley
from tillroll.operators.layout import checkpointed
from tillroll.operators.models import CHURN_FOREST, SEED, Fitted, fit_churn_model

# What the document tells about an explained prediction, after its index.
_EXPLAINED = (
    "customer_id",
    "predicted_churn_probability",
    "actual_label",
    "feature_values",
    "shap_contributions",
)


def first_customers(predictions: DataFrame, n: int = 5) -> DataFrame:
    """The predictions the document quotes: those of the lowest customer numbers."""
    return predictions.orderBy("CustomerID").limit(n)


def explain_churn(
    fitted: Fitted,
    rows: DataFrame,
    features: Sequence[str] = CHURN_FEATURES,
    background_size: int = BACKGROUND_ROWS,
) -> DataFrame:
    """Shapley values of the churn probability for the given customers.

    ``rows`` may be all predictions: explanations are a relation with a row per customer.
    """
    background = background_rows(fitted.train, features, ["CustomerID"], background_size)
    nodes = forest_nodes(fitted.model, rows.sparkSession)
    return forest_shapley(rows, background, features, nodes, ["CustomerID", "label"])


def evaluate_churn(
    customers: DataFrame,
    n_quoted: int = 5,
    features: Sequence[str] = CHURN_FEATURES,
    churn_days: int = CHURN_DAYS,
    forest: Mapping[str, Any] = CHURN_FOREST,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Fit a forest on a labelled customer table and judge it on held-out customers.

    Returns the result document and the metrics per segment. The document is a report of one
    row and quotes ``n_quoted`` explanations; :func:`explain_churn` has them all.
    """
    fitted = fit_churn_model(customers, features, seed, forest)
    fitted = fitted._replace(predictions=checkpointed(fitted.predictions))
    explained = explain_churn(fitted, first_customers(fitted.predictions, n_quoted), features)
    document = churn_document(fitted.predictions, explained, features, churn_days, forest)
    return document, segment_metrics(fitted.predictions)


def _as_map(key: str, value: Column) -> Column:
    """Rows folded to a map. For relations of a row per segment or metric only."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key), value))))


def churn_document(
    predictions: DataFrame,
    explained: DataFrame,
    features: Sequence[str] = CHURN_FEATURES,
    churn_days: int = CHURN_DAYS,
    forest: Mapping[str, Any] = CHURN_FOREST,
) -> DataFrame:
    """The evaluation as one nested row, ready for a JSON sink.

    Every part is a small aggregate (a row per segment, metric or explained
    customer), read as a scalar subquery of the one row.
    """
    measures = F.struct("n", "n_churned", "n_active", *METRICS)
    overall = classification_metrics(predictions).select(measures.alias("part"))
    per_segment = segment_metrics(predictions)
    segments = per_segment.agg(_as_map("segment", measures).alias("part"))
    compared = per_segment.agg(F.array_sort(F.collect_list("segment")).alias("part"))

    gap = F.map_from_arrays(
        F.array("segment_a", "segment_b", F.lit("difference")),
        F.array("value_a", "value_b", "difference"),
    )
    gaps = (
        fairness_report(per_segment)
        .withColumn("gap", gap)
        .agg(
            F.map_from_entries(F.collect_list(F.struct("metric", "gap"))).alias("disparities"),
            F.max("max_disparity").alias("max_disparity"),
            F.coalesce(F.bool_or("fairness_concern"), F.lit(False)).alias("fairness_concern"),
        )
        .select(F.struct("*").alias("part"))
    )
    explanation = F.struct(
        F.col("CustomerID").alias("customer_id"),
        F.round("score", 4).alias("predicted_churn_probability"),
        F.col("label").alias("actual_label"),
        F.struct(*features).alias("feature_values"),
        F.struct(*[F.round(f"phi_{f}", 4).alias(f) for f in features]).alias(
            "shap_contributions"
        ),
    )
    numbered = F.transform(
        F.array_sort(F.collect_list(explanation)),
        lambda one, i: F.struct(
            i.alias("prediction_index"), *[one[name].alias(name) for name in _EXPLAINED]
        ),
    )
    explanations = explained.agg(numbered.alias("part"))
    # Names and texts of the document.
    settings = ", ".join(f"{name}={value}" for name, value in forest.items())
    parts = predictions.sparkSession.range(1).select(
        overall.scalar().alias("overall_metrics"),
        segments.scalar().alias("segment_metrics"),
        compared.scalar().alias("segments_compared"),
        gaps.scalar().alias("gaps"),
        explanations.scalar().alias("shap_explanations"),
    )
    return parts.select(
        F.lit("customer_churn_classification").alias("task"),
        F.lit(f"no purchase in the last {churn_days} days").alias("churn_definition"),
        F.array(*[F.lit(f) for f in features]).alias("features"),
        F.lit(f"Spark MLlib RandomForestClassifier ({settings})").alias("model"),
        "overall_metrics",
        "segment_metrics",
        F.struct("segments_compared", "gaps.*").alias("fairness_report"),
        "shap_explanations",
    )


def flat_fairness(per_segment: DataFrame) -> DataFrame:
    """Per-segment metrics in the columns of the flat report."""
    return per_segment.select("segment", "n", *METRICS).orderBy("segment")

import random

import pytest
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.sql import functions as F

from tillroll.operators import evaluation
from tillroll.plans.churn import flat_fairness

ROWS = "segment string, label int, prediction double, score double"


def random_predictions(spark, n=600, levels=25, seed=1, share=0.4):
    """Scores on a grid, so that there are ties within and between the classes."""
    source = random.Random(seed)
    rows = []
    for _ in range(n):
        label = int(source.random() < share)
        score = round((label * 0.3 + source.random()) * levels) / levels
        rows.append((source.choice("ABC"), label, float(score > 0.7), score))
    return spark.createDataFrame(rows, ROWS).repartition(3)


def brute_force_auc(rows):
    wins = pairs = 0.0
    for _, label, _, score in rows:
        for _, other, _, other_score in rows:
            if label == 1 and other == 0:
                pairs += 1
                wins += 1.0 if score > other_score else 0.5 if score == other_score else 0.0
    return wins / pairs if pairs else None


@pytest.mark.parametrize("ranges", [1, 2, 7, 256])
def test_auc_equals_counting_pairs(spark, ranges):
    predictions = random_predictions(spark)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    found = evaluation.auc_roc(predictions).first()["auc_roc"]
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == pytest.approx(brute_force_auc(predictions.collect()), abs=1e-12)


def test_auc_per_group_equals_counting_pairs(spark):
    predictions = random_predictions(spark, levels=400)
    per_segment = evaluation.auc_roc(predictions, ["segment"])
    found = {r["segment"]: r["auc_roc"] for r in per_segment.collect()}
    for segment in "ABC":
        rows = [r for r in predictions.collect() if r["segment"] == segment]
        assert found[segment] == pytest.approx(brute_force_auc(rows), abs=1e-12)


def test_one_score_for_almost_everyone(spark):
    rows = [("A", i % 3 == 0 and 1 or 0, 0.0, 0.5 if i % 50 else i / 1000) for i in range(1000)]
    predictions = spark.createDataFrame(rows, ROWS)
    found = evaluation.auc_roc(predictions).first()["auc_roc"]
    assert found == pytest.approx(brute_force_auc(rows), abs=1e-12)


def test_metrics_equal_the_library_evaluators(spark):
    predictions = random_predictions(spark).withColumn("label", F.col("label").cast("double"))
    found = evaluation.classification_metrics(predictions, digits=12).first()
    multi = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for name, metric in {
        "precision": "weightedPrecision",
        "recall": "weightedRecall",
        "f1": "f1",
    }.items():
        expected = multi.evaluate(predictions, {multi.metricName: metric})
        assert found[name] == pytest.approx(expected, abs=1e-11)
    binary = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="score", numBins=0, metricName="areaUnderROC"
    )
    assert found["auc_roc"] == pytest.approx(binary.evaluate(predictions), abs=1e-11)


def test_regression_equals_the_library_evaluator(spark):
    source = random.Random(3)
    rows = [(source.gauss(50, 9), source.gauss(50, 9)) for _ in range(500)]
    predictions = spark.createDataFrame(rows, "actual double, predicted double")
    found = evaluation.regression_metrics(predictions).first()
    for name in ("rmse", "r2"):
        evaluator = RegressionEvaluator(
            labelCol="actual", predictionCol="predicted", metricName=name
        )
        assert found[name] == pytest.approx(evaluator.evaluate(predictions), rel=1e-10)


def test_one_class_has_no_auc(spark):
    predictions = spark.createDataFrame([("A", 1, 1.0, 0.9), ("A", 1, 0.0, 0.2)], ROWS)
    row = evaluation.classification_metrics(predictions).first()
    assert row["auc_roc"] is None
    assert (row["n"], row["n_churned"], row["n_active"]) == (2, 2, 0)
    assert (row["precision"], row["recall"]) == (1.0, 0.5)


def test_a_class_never_predicted_counts_as_zero(spark):
    rows = [("A", 1, 0.0, 0.1), ("A", 0, 0.0, 0.1), ("A", 0, 0.0, 0.2), ("A", 0, 0.0, 0.3)]
    row = evaluation.classification_metrics(spark.createDataFrame(rows, ROWS)).first()
    assert row["precision"] == round(0.75 * 0.75, 4)
    assert row["recall"] == 0.75


def test_no_predictions(spark):
    empty = spark.createDataFrame([], ROWS)
    row = evaluation.classification_metrics(empty).first()
    assert row["n"] == 0 and row["precision"] is None
    assert evaluation.segment_metrics(empty).count() == 0


SEGMENTS = "segment string, n bigint, auc_roc double, precision double, recall double, f1 double"


def report(spark, *rows):
    per_segment = spark.createDataFrame(rows, SEGMENTS)
    return {r["metric"]: r for r in evaluation.fairness_report(per_segment).collect()}


def test_fairness_of_two_segments(spark):
    found = report(
        spark,
        ("Abroad", 40, 0.9, 0.65, 0.7, 0.68),
        ("Home", 260, 0.85, 0.67, 0.74, 0.71),
    )
    assert {m: r["difference"] for m, r in found.items()} == {
        "auc_roc": 0.05,
        "precision": 0.02,
        "recall": 0.04,
        "f1": 0.03,
    }
    verdicts = {(r["max_disparity"], r["fairness_concern"]) for r in found.values()}
    assert verdicts == {(0.05, False)}
    assert found["f1"]["segment_a"] == "Abroad" and found["f1"]["value_b"] == 0.71


def test_a_gap_of_exactly_the_threshold_is_no_concern(spark):
    found = report(spark, ("A", 1, 0.5, 0.5, 0.5, 0.5), ("B", 1, 0.6, 0.5, 0.5, 0.5))
    assert found["auc_roc"]["difference"] == 0.1 and not found["auc_roc"]["fairness_concern"]
    found = report(spark, ("A", 1, 0.5, 0.5, 0.5, 0.5), ("B", 1, 0.6001, 0.5, 0.5, 0.5))
    assert found["auc_roc"]["fairness_concern"]


def test_a_missing_metric_is_left_out(spark):
    found = report(spark, ("A", 1, None, 0.5, 0.5, 0.5), ("B", 1, 0.9, 0.5, 0.5, 0.5))
    assert "auc_roc" not in found and found["f1"]["max_disparity"] == 0.0


@pytest.mark.parametrize("segments", ["A", "ABC"])
def test_only_two_segments_are_compared(spark, segments):
    assert report(spark, *[(s, 1, 0.5, 0.5, 0.5, 0.5) for s in segments]) == {}


def test_flat_report_columns(spark):
    per_segment = evaluation.segment_metrics(random_predictions(spark))
    flat = flat_fairness(per_segment)
    assert flat.columns == ["segment", "n", "auc_roc", "precision", "recall", "f1"]
    assert [r["segment"] for r in flat.collect()] == ["A", "B", "C"]


def test_scores_that_cannot_be_ranked(spark):
    rows = [(1, 0.9, 1.0), (0, 0.1, 0.0), (1, 0.4, 0.0), (0, 0.6, 1.0), (0, None, 0.0), (1, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "label int, score double, prediction double")
    ranked = df.where("score IS NOT NULL AND NOT isnan(score)")
    found, expected = (evaluation.classification_metrics(d).first() for d in (df, ranked))
    assert found["auc_roc"] == expected["auc_roc"] == 0.75
    assert (found["n"], expected["n"]) == (6, 4)
    only = df.where("score IS NULL OR isnan(score)")
    assert evaluation.auc_roc(only).first()["auc_roc"] is None


def test_groups_of_any_kind_over_many_partitions(spark):
    source = random.Random(6)
    rows = []
    for _ in range(4000):
        group = source.choice([("x", 1), ("x", None), (None, 1), ("", 2), ("null", 1)])
        score = source.choice([source.randrange(400) / 7, -0.0, 0.0, None, float("nan")])
        rows.append((*group, source.randrange(2), float(source.randrange(2)), score))
    df = spark.createDataFrame(rows, "a string, b int, label int, prediction double, score double")
    expected = {}
    for a, b, label, _, score in rows:
        if score is not None and score == score:
            expected.setdefault((a, b), ([], []))[label].append(score)
    found = {(r["a"], r["b"]): r["auc_roc"] for r in evaluation.auc_roc(df.repartition(9), ["a", "b"]).collect()}
    assert set(found) == set(expected)
    for group, (negative, positive) in expected.items():
        wins = sum((p > n) + (p == n) / 2 for p in positive for n in negative)
        assert found[group] == pytest.approx(wins / len(positive) / len(negative), rel=1e-12)
    plan = evaluation.auc_roc(df, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1

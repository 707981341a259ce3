import json

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tillroll.operators import calendar, customers, evaluation, models
from tillroll.plans import churn, training
from tillroll.sources import write_json_document
from verification.queries import HOLIDAYS, clean_lines, labelled

SMALL_FOREST = {"numTrees": 8, "maxDepth": 4}
SMALL_GRID = {"maxDepth": [2, 3], "numTrees": [4]}


@pytest.fixture(scope="module")
def lines(spark, folder):
    kept = clean_lines(spark, folder).cache()
    yield kept
    kept.unpersist()


@pytest.fixture(scope="module")
def fitted(spark, folder):
    return models.fit_churn_model(labelled(spark, folder), forest=SMALL_FOREST)


def test_forecast_is_least_squares(lines):
    daily = calendar.daily_model_frame(lines, HOLIDAYS)
    found = models.fit_sales_forecast(daily)
    rows = found.train.select(*calendar.DAY_FEATURES, "daily_revenue").collect()
    values = np.array([tuple(r) for r in rows], dtype=float)
    inputs = np.column_stack([values[:, :-1], np.ones(len(values))])
    expected, *_ = np.linalg.lstsq(inputs, values[:, -1], rcond=None)
    learned = [*found.model.coefficients.toArray(), found.model.intercept]
    assert learned == pytest.approx(expected, rel=1e-6, abs=1e-4)


def test_train_and_test_days_are_disjoint(lines):
    daily = calendar.daily_model_frame(lines, HOLIDAYS)
    found = models.fit_sales_forecast(daily)
    train, test = (
        {r["sale_date"] for r in df.select("sale_date").collect()}
        for df in (found.train, found.predictions)
    )
    assert not train & test and len(train | test) == daily.count()


def test_demand_model_picks_from_the_grid(lines):
    found = models.fit_demand_model(
        calendar.create_temporal_features(lines, HOLIDAYS), fraction=0.5, grid=SMALL_GRID
    )
    assert found.model.getOrDefault("maxDepth") in SMALL_GRID["maxDepth"]
    assert found.model.getNumTrees == 4
    assert found.predictions.where(F.col("prediction").isNull()).count() == 0


def test_joint_predictions(lines):
    joint = training.model_predictions(lines, HOLIDAYS, grid=SMALL_GRID)
    assert joint.columns == ["model", "actual", "predicted"]
    assert [t for _, t in joint.dtypes] == ["string", "double", "double"]
    by_model = {r["model"]: r for r in evaluation.regression_metrics(joint, ["model"]).collect()}
    assert set(by_model) == {"linear_regression", "random_forest"}
    one = joint.where("model = 'linear_regression'")
    rmse = RegressionEvaluator(labelCol="actual", predictionCol="predicted").evaluate(one)
    assert by_model["linear_regression"]["rmse"] == pytest.approx(rmse)


def test_importances_sum_to_one_in_order(spark, fitted):
    found = models.feature_importances(fitted.model, customers.CHURN_FEATURES, spark).collect()
    values = [r["importance"] for r in found]
    assert {r["feature"] for r in found} == set(customers.CHURN_FEATURES)
    assert sum(values) == pytest.approx(1.0) and values == sorted(values, reverse=True)


def test_scores_are_probabilities_behind_the_class(fitted):
    rows = fitted.predictions.select("prediction", "score").collect()
    assert rows and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["prediction"] == (r["score"] > 0.5) for r in rows if r["score"] != 0.5)


def test_rows_with_missing_features_can_be_skipped(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert models.assemble(df, ["x"], handle_invalid="skip").count() == 1


def test_explanations_of_a_forest_add_up(fitted):
    rows = churn.first_customers(fitted.predictions, 3)
    explained = churn.explain_churn(fitted, rows, background_size=20).collect()
    scores = {r["CustomerID"]: r["score"] for r in rows.collect()}
    assert len(explained) == 3
    for r in explained:
        total = sum(r[f"phi_{f}"] for f in customers.CHURN_FEATURES)
        assert total == pytest.approx(r["score"] - r["base_value"], abs=1e-9)
        assert r["score"] == pytest.approx(scores[r["CustomerID"]], abs=1e-12)


def test_result_document(spark, folder, tmp_path):
    document, _ = churn.evaluate_churn(labelled(spark, folder), n_quoted=2, forest=SMALL_FOREST)
    write_json_document(document, str(tmp_path / "doc"))
    (file,) = [f for f in (tmp_path / "doc").glob("part*.txt") if f.stat().st_size]
    found = json.loads(file.read_text())
    assert list(found) == [
        "task",
        "churn_definition",
        "features",
        "model",
        "overall_metrics",
        "segment_metrics",
        "fairness_report",
        "shap_explanations",
    ]
    sizes = [m["n"] for m in found["segment_metrics"].values()]
    assert sum(sizes) == found["overall_metrics"]["n"]
    assert found["fairness_report"]["segments_compared"] == sorted(found["segment_metrics"])
    assert len(found["shap_explanations"]) == 2
    first = found["shap_explanations"][0]
    assert first["prediction_index"] == 0
    assert list(first["shap_contributions"]) == list(customers.CHURN_FEATURES)


def test_document_with_two_segments(spark):
    rows = [
        ("A", i % 2, float(i % 3 == 0), i / 10, i) if i < 6 else ("B", i % 2, 1.0, i / 20, i)
        for i in range(12)
    ]
    predictions = spark.createDataFrame(
        rows, "segment string, label int, prediction double, score double, CustomerID int"
    )
    explained = spark.createDataFrame(
        [(1.0, 1, 0.5, 2.0, 0.25)],
        "CustomerID double, label int, score double, x double, phi_x double",
    )
    document = churn.churn_document(predictions, explained, features=["x"]).first()
    report = document["fairness_report"]
    assert set(report["disparities"]) == set(evaluation.METRICS)
    gap = report["disparities"]["recall"]
    assert gap["difference"] == round(abs(gap["A"] - gap["B"]), 4)
    assert report["max_disparity"] == max(g["difference"] for g in report["disparities"].values())
    assert report["fairness_concern"] == (report["max_disparity"] > 0.10)


def test_all_held_out_lines_are_scored(lines):
    marked = calendar.create_temporal_features(lines, HOLIDAYS)
    train, test = models.demand_parts(marked, fraction=0.3)
    found = models.fit_demand_model(marked, fraction=0.3, grid=SMALL_GRID)
    assert found.predictions.count() == test.count() > 0.15 * lines.count()
    assert found.train.count() == train.count() < 0.35 * lines.count()


def test_tuning_names_the_smallest_error(spark, lines):
    marked = calendar.create_temporal_features(lines, HOLIDAYS)
    found = models.fit_demand_model(marked, fraction=0.5, grid=SMALL_GRID)
    rows = models.tuning_results(found, spark).collect()
    assert {(r["maxDepth"], r["numTrees"]) for r in rows} == {(2, 4), (3, 4)}
    (chosen,) = [r for r in rows if r["chosen"]]
    assert chosen["rmse"] == min(r["rmse"] for r in rows)
    assert chosen["maxDepth"] == found.model.getOrDefault("maxDepth")


def test_guests_are_no_customers_of_the_churn_model(spark, folder):
    table = labelled(spark, folder)
    guest = table.limit(1).withColumns(
        {"CustomerID": F.lit(None).cast("double"), "average_transaction_value": F.lit(None).cast("double")}
    )
    found = models.fit_churn_model(table.unionByName(guest), forest=SMALL_FOREST)
    assert found.predictions.where("CustomerID IS NULL").count() == 0
    assert found.predictions.count() + found.train.count() == table.count()
